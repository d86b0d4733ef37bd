"""Reading sources by rule, and writing profiles and models."""
