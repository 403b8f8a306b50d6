"""Business plans: silver, gold and reports as functions over frames."""
