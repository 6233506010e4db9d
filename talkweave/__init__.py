"""talkweave: time-interval analytics for recorded conversations, written as Spark plans."""

__version__ = "0.1.0"
