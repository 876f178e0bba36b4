"""tillflow: a Bronze / Silver / Gold analytics layer for point-of-sale lines on Spark.

Every transformation is a function from DataFrame to DataFrame; only the
modules under ``sinks`` and ``streaming`` start jobs that write.
"""
