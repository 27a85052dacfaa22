"""Business plans, each a DataFrame-to-DataFrame function usable in batch and inside a micro-batch."""
