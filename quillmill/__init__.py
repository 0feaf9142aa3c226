"""Spark-native screening of bibliographic catalogs and curation of text corpora."""
