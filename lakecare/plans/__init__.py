"""Layer plans: silver, gold, serving views and reports."""
