"""The one error that operators raise for bad inputs."""


class DataError(RuntimeError):
    """An input is missing, malformed or unfit for the requested operator."""
