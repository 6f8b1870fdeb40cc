"""User-level jobs: train, evaluate, persist and score."""
