"""siltworks: a PySpark-native engine for documentation crawls and training data.

Layout: ``functions`` are column expressions, ``operators`` DataFrame
transforms, ``sources`` readers and writers, ``plans`` whole pipelines,
``streaming`` the micro-batch forms, ``queries`` the registered queries of
the core. ``llm`` is a separate subpackage that nothing else imports.
"""
