"""Layer plans: validated tables, marts, derived metrics, checks, and the on-disk run."""
