"""Column expressions. None of them needs a Python worker."""
