"""The four jobs: prepare, training text, evaluate, explore."""
