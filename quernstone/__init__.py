"""quernstone: a catalogue import and training-data engine on PySpark."""

__version__ = "0.1.0"
