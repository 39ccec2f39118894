from reelspark.functions.scalars import *  # noqa: F401,F403
