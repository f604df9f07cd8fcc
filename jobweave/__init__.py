"""Labour-market analytics as Spark DataFrame jobs.

``functions`` holds Column builders, ``operators`` DataFrame transforms,
``sources`` readers and writers, ``plans`` the models (staging to marts),
``streaming`` the incremental forms, ``verify`` the registered queries with
their oracle SQL.
"""
