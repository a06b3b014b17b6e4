"""Structured Streaming forms of the operators that make sense on growing inputs."""
