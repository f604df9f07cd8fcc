"""Operations of a training-data pipeline, each a Spark job.

One module per operator; ``queries`` registers them, ``common`` holds what they
share. Nothing else in the library imports this subpackage.
"""
