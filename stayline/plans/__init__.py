"""Whole jobs, composed from the operators. ``tables`` is any object with the attributes of
``sources.inputs.Inputs``; ``as_of`` stands for today."""
