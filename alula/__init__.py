"""alula -- landmark morphometrics as Spark jobs.

Sub-packages: ``functions`` (Column expressions), ``sources`` (readers and
writers), ``operators`` (DataFrame-to-DataFrame operators), ``plans``
(end-to-end jobs) and ``streaming`` (Structured Streaming jobs).
"""
