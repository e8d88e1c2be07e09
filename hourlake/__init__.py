"""hourlake: an event lakehouse as ordinary Spark jobs."""

from hourlake.session import builder, pin_utc

__all__ = ["builder", "pin_utc"]
