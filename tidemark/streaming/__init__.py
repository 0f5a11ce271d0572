from .job import ChangeStream, offset_ranges

__all__ = ["ChangeStream", "offset_ranges"]
