"""Where bars come from and where result tables go."""
