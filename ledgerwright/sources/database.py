"""Tables of a database, over JDBC: read in ranges of a column, and written in batches."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BATCH = 10_000


def read_table(spark: SparkSession, url: str, table: str, column: str | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """A table, in so many reads by ranges of a number, date or timestamp column.

    The database tells the column's bounds; they only cut the ranges, so rows that come later or
    have no value are read too. Filters and column selection go to the database. An empty table
    and one without `column` are one read.
    """
    source = spark.read.format("jdbc").options(url=url, fetchsize=BATCH, **options)
    if not column or partitions < 2:
        return source.option("dbtable", table).load()
    name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
    bounds = f"SELECT MIN({name}) AS low, MAX({name}) AS high FROM {table}"
    low, high = spark.read.format("jdbc").options(url=url, query=bounds, **options).load().first()
    if low is None:
        return source.option("dbtable", table).load()
    return source.options(dbtable=table, partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=partitions).load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 8, **options: str) -> None:
    """Insert rows over at most so many connections; each commits once a task, so a task that is lost leaves nothing of its own."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=BATCH, numPartitions=connections, **options).mode(mode).save()


def publish_table(df: DataFrame, url: str, table: str, run_id: str, batch: tuple[str, str] | None = None, connections: int = 8, **options: str) -> int:
    """Put rows in place of a table's, or of those of one batch (column, value), all at once or not at all; how many.

    The rows go to a table of the run's own first, however often tasks or the whole run are tried, and
    one transaction takes them over if they are as many as they should be; a publication that is
    repeated changes nothing. Where it fails the table stays as it was.
    """
    spark = df.sparkSession
    own = f"{table}_{re.sub('[^A-Za-z0-9]', '', run_id)}"
    many = df.count()
    write_table(df, url, own, "overwrite", connections, **options)
    jvm = spark._jvm
    quote = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        properties.setProperty(key, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            found = statement.executeQuery(f"SELECT COUNT(*) FROM {own}")
            found.next()
            if (written := found.getLong(1)) != many:
                raise ValueError(f"{own} has {written} rows, not {many}")
            found.close()
            if batch:
                old = connection.prepareStatement(f"DELETE FROM {table} WHERE {quote(batch[0])} = ?")
                old.setString(1, batch[1])
                old.executeUpdate()
                old.close()
            else:
                statement.executeUpdate(f"DELETE FROM {table}")
            columns = ", ".join(quote(c) for c in df.columns)
            statement.executeUpdate(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {own}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            # not in the transaction, since some databases end it with a table's creation or removal
            statement.executeUpdate(f"DROP TABLE {own}")
            connection.commit()
            statement.close()
    finally:
        connection.close()
    return many
