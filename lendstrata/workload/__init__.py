"""Every operator over the driver's tables, each with an equivalent SQL oracle."""
