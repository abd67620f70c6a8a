"""Errors of the library."""


class RoadlensError(Exception):
    """Any of the errors below."""


class ConfigError(RoadlensError):
    """A configuration file is missing, empty or not a mapping."""


class RatioError(RoadlensError, ValueError):
    """Split ratios do not add up to 1."""


class SourceError(RoadlensError):
    """A source cannot be read."""


class LeakageError(RoadlensError):
    """Splits share rows."""
