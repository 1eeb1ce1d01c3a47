"""Column expressions. All of them are JVM built-ins and none depends on ANSI mode."""
