"""Registered queries and the SQL each must agree with."""

QUERIES = {}
SQL = {}


def query(name, sql=None):
    """Register a (spark, folder) function, with its SQL where there is one."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def load(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def file_or_folder(folder, name):
    """A table's path for a stream: as a pattern it may be a file or a folder."""
    return f"{folder}/{{{name}.parquet}}"
