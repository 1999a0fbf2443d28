"""Reading inputs, writing outputs, and mapping the given star schema to the input model."""
