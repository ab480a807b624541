"""Readers, writers and the bindings of the driver's tables to the engine's inputs."""
