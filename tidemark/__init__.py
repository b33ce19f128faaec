"""Session-log, ad-event and metric analytics as lazy PySpark DataFrame operators."""
