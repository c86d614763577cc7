"""Readers and discoverers of inputs."""
