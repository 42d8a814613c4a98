"""Readers and writers of preference data, prompt sets and run artifacts."""
