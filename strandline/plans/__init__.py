"""From scenes and shoreline points to trends: a list of stages over named frames."""
