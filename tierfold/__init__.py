"""Layered analytics (landing -> raw -> bronze -> silver -> gold) as Spark DataFrame operators.

Every public function takes and returns Columns or DataFrames; nothing here owns a session.
"""

__version__ = "0.1.0"
