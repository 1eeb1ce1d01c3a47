"""Source cleaners, the star-schema mart, gold tables and the whole run."""
