"""Reading partitioned, sharded and report data, and writing it back."""
