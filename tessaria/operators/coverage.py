"""Coverage: which groups have data, share another's file, or have none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_count(rows: DataFrame, entries: DataFrame, key: str, entry_key: str, out: str) -> DataFrame:
    """``rows`` with the number of ``entries`` of each key, 0 without any."""
    counts = entries.groupBy(F.col(entry_key).alias("c_key")).agg(F.count("*").alias(out))
    return rows.join(counts, F.col(key) == F.col("c_key"), "left").drop("c_key").withColumn(out, F.coalesce(out, F.lit(0)))


def share_index(rows: DataFrame, url_col: str, count_col: str) -> DataFrame:
    """(url, n_sharing, any_data) of every address that is not empty."""
    return rows.filter(F.coalesce(url_col, F.lit("")) != "").groupBy(F.col(url_col).alias("url")).agg(F.count("*").alias("n_sharing"), F.bool_or(F.col(count_col) > 0).alias("any_data"))


def with_share(rows: DataFrame, url_col: str, count_col: str) -> DataFrame:
    """``rows`` with n_sharing and any_data of their address."""
    index = share_index(rows, url_col, count_col).withColumnRenamed("url", "s_url")
    return rows.join(index, F.col(url_col) == F.col("s_url"), "left").drop("s_url").withColumns({"n_sharing": F.coalesce("n_sharing", F.lit(0)), "any_data": F.coalesce("any_data", F.lit(False))})


def delivery_status(n: Column, n_sharing: Column, any_data: Column) -> Column:
    return F.when(n > 0, "ok").when((n_sharing > 1) & any_data, "compartilhado").otherwise("sem_dados")


def risk_status(url: Column, n: Column, n_sharing: Column, any_data: Column) -> Column:
    """A group without an address has no file, whatever else there is."""
    return F.when(F.coalesce(url, F.lit("")) == "", "sem_pdf").when(n > 0, "ok").when((n_sharing > 1) & any_data, "compartilhado").otherwise("no_risk_table")


def coverage(organs: DataFrame, deliveries: DataFrame, risks: DataFrame) -> DataFrame:
    """A row for each group: files, counts and both statuses, in order of the acronym."""
    rows = with_count(organs, deliveries, "sigla", "orgao_sigla", "entregas_extraidas")
    rows = with_share(rows, "url_entregas", "entregas_extraidas").withColumn("status_entregas", delivery_status(F.col("entregas_extraidas"), F.col("n_sharing"), F.col("any_data"))).drop("n_sharing", "any_data")
    rows = with_count(rows, risks, "sigla", "orgao_sigla", "riscos_extraidos")
    rows = with_share(rows, "url_diretivo", "riscos_extraidos").withColumn("status_riscos", risk_status(F.col("url_diretivo"), F.col("riscos_extraidos"), F.col("n_sharing"), F.col("any_data")))
    flag = lambda c: F.when(F.coalesce(c, F.lit("")) != "", "sim").otherwise("nao")
    return rows.select("sigla", F.coalesce("grupo", F.lit("")).alias("grupo"), flag("url_diretivo").alias("pdf_diretivo"), flag("url_entregas").alias("pdf_entregas"), "entregas_extraidas", "riscos_extraidos", "status_entregas", "status_riscos").orderBy("sigla")
