"""reglink: record linkage of an event queue against a person register, on Spark.

Everything is DataFrame code: fuzzy joins are candidate generation (exploded
segments / tokens, equi-joins) followed by verification with built-in string
functions, so no stage holds a cross product.
"""

from reglink.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
