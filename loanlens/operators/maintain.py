"""Table maintenance with load semantics, as pure functions ``(target, source) -> new target``.

Plain Parquet has no MERGE, so each load step returns the new table; the caller
writes it to a new path or overwrites the touched partitions (dynamic partition
overwrite by ``report_date``).  Every step is idempotent when replayed with the
same source, except ``additive_merge``, which is guarded by the load log;
``additive_replace`` keeps what each file gave and so can take a file again.
All joins are on the loan key (or the period and loan key): one shuffle per side,
hash-partitioned, and AQE splits a skewed partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.functions import rules
from loanlens.functions.clean import mmyyyy_date, null_tokens, year_from_mmyyyy
from loanlens.operators.joins import dedupe_first
from loanlens.sources.records import record_fields

MONEY = "decimal(14,2)"


def ties(df: DataFrame) -> Column:
    """Last term of an order: the whole row as text, so rows that still tie are equal in every column."""
    return F.to_json(F.struct(*df.columns)).asc()


def insert_if_absent(target: DataFrame, source: DataFrame, keys, *, order_by) -> DataFrame:
    """First write wins: source rows (one per key, the first by ``order_by``) whose key is not in the target are appended."""
    keys = list(keys)
    src = dedupe_first(source, keys, [*order_by, ties(source)])
    return target.unionByName(src.join(target.select(*keys), keys, "left_anti"))


def append_raw(target: DataFrame, source: DataFrame) -> DataFrame:
    """Rows appended without a key check."""
    return target.unionByName(source)


def quarantine(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Tag each row with the first failed check (``_reason``, null when valid); the load goes on."""
    reason = None
    for name, ok in checks.items():
        cond = ~F.coalesce(ok, F.lit(False))
        reason = F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name))
    return df.withColumn("_reason", reason)


def quarantine_counts(tagged: DataFrame) -> DataFrame:
    """Rows per reason (``valid`` for the good rows)."""
    return tagged.groupBy(F.coalesce("_reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def merge_scd1(target: DataFrame, source: DataFrame, keys, *, order_by, now, created: str = "created_at",
               updated: str = "last_updated", preserve=("created_at",), version: str | None = None, unique: bool = False) -> DataFrame:
    """Upsert one row per key.

    Of several source rows of a key the first by ``order_by`` counts; ``unique`` says that there is one, and none with a null key.  Matched keys take every attribute from the source (a null in the source
    overwrites), ``last_updated = now``; ``created_at`` is kept from the target
    when listed in ``preserve`` (else overwritten with ``now``).  Source-only keys
    are inserted with both timestamps ``now``.  Target-only keys stay as they are.
    With ``version`` (a column of both, such as the as-of month) a source row of an older version
    than the target's changes nothing, so files may come in any order; a null version is the
    oldest.  Without it the last load wins.
    A full outer join on the key; the side is chosen by a source-presence flag,
    not by ``coalesce``, so nulls from the source win.
    """
    keys = list(keys)
    now_c = F.lit(now).cast("timestamp") if not isinstance(now, Column) else now
    src = (source if unique else dedupe_first(source, keys, [*order_by, ties(source)])).withColumn("_in_src", F.lit(True))
    tgt = target.withColumn("_in_tgt", F.lit(True))
    attrs = [c for c in source.columns if c not in keys and c not in (created, updated)]
    s, t = src.alias("s"), tgt.alias("t")
    cond = None
    for k in keys:
        c = F.col(f"s.{k}") == F.col(f"t.{k}")
        cond = c if cond is None else cond & c
    j = s.join(t, cond, "full_outer")
    ins = F.col("s._in_src").isNotNull()
    if version:
        older = F.col("t._in_tgt").isNotNull() & F.coalesce(F.col(f"s.{version}") < F.col(f"t.{version}"), F.col(f"s.{version}").isNull() & F.col(f"t.{version}").isNotNull())
        ins = ins & ~older
    out = [F.coalesce(F.col(f"s.{k}"), F.col(f"t.{k}")).alias(k) for k in keys]
    out += [F.when(ins, F.col(f"s.{a}")).otherwise(F.col(f"t.{a}")).alias(a) for a in attrs]
    if created in preserve:
        cr = F.when(ins & F.col("t._in_tgt").isNull(), now_c).otherwise(F.col(f"t.{created}"))
    else:
        cr = F.when(ins, now_c).otherwise(F.col(f"t.{created}"))
    out += [cr.alias(created), F.when(ins, now_c).otherwise(F.col(f"t.{updated}")).alias(updated)]
    return j.select(*out)


def split_new_existing(target: DataFrame, source: DataFrame, keys, *, order_by, now) -> DataFrame:
    """Older form: new keys inserted, existing keys updated including ``created_at``."""
    return merge_scd1(target, source, keys, order_by=order_by, now=now, preserve=())


def replace_period(target: DataFrame, source: DataFrame, keys, *, period_col: str = "report_date",
                   period=None, tasks: int | None = None) -> DataFrame:
    """Delete the period's rows for keys present in the file, insert the file's rows.

    Other keys of the same period survive; replaying the same file gives the
    same table.  With ``period`` the source rows get that period value.  With ``tasks`` keys and
    rows meet in that many tasks.
    """
    keys = list(keys)
    src = source if period is None else source.withColumn(period_col, F.lit(period).cast("date"))
    gone = src.select(period_col, *keys)
    gone = (gone.repartition(tasks, period_col, *keys) if tasks else gone).distinct()
    return target.join(gone, [period_col, *keys], "left_anti").unionByName(src.select(*target.columns))


def _balance() -> Column:
    return F.col("unpaid_principal_balance").try_cast(MONEY)


def monthly_projection(staging: DataFrame, *, report_date=None, keys=("disclosure_sequence_number",), unique: bool = False) -> DataFrame:
    """LL staging strings -> loan-month rows: typed columns, 0 for missing balance, age and months late.

    One row per key (a file should not repeat a loan); ``keys`` adds the file month
    when the staging holds several monthly files at once.  ``unique`` says that the staging
    has one record per key already, picked as here (``first_records``).
    """
    s = staging if unique else dedupe_first(staging, list(keys),
                                            [F.col("as_of_date").asc_nulls_last(), _balance().asc_nulls_last(), ties(staging)])
    md = F.col("months_delinquent").try_cast("int")
    rd = (F.lit(report_date).cast("date") if report_date is not None
          else F.try_to_timestamp(F.concat(F.col("as_of_date"), F.lit("01")), F.lit("yyyyMMdd")).cast("date"))
    return s.select("disclosure_sequence_number", rd.alias("report_date"),
                    F.col("issuer_id").try_cast("int").alias("issuer_id"),
                    F.coalesce(F.col("unpaid_principal_balance").try_cast(MONEY), F.lit(0).cast(MONEY))
                    .alias("unpaid_principal_balance"),
                    F.coalesce(F.col("loan_age").try_cast("int"), F.lit(0)).alias("loan_age_months"),
                    F.coalesce(md, F.lit(0)).alias("months_delinquent"),
                    rules.dq_label(md).alias("delinquency_status"))


def static_projection(staging: DataFrame, *, keep=(), tasks: int | None = None, unique: bool = False) -> DataFrame:
    """LL staging strings -> static loan attributes (typed), with the columns ``keep`` as they are; ``tasks`` as in ``dedupe_first``.

    ``unique`` says that the staging has one record per loan already, picked as here.
    """
    s = staging if unique else dedupe_first(
        staging, ["disclosure_sequence_number"],
        [F.col("as_of_date").desc_nulls_last(), _balance().asc_nulls_last(), ties(staging)], tasks=tasks)
    return s.select("disclosure_sequence_number", F.col("issuer_id").try_cast("int").alias("issuer_id"),
                    "state_code", "msa",
                    F.col("original_principal_balance").try_cast(MONEY).alias("original_principal_balance"),
                    F.col("loan_interest_rate").try_cast("decimal(6,3)").alias("loan_interest_rate"),
                    F.col("loan_to_value").try_cast("decimal(7,2)").alias("ltv"),
                    F.col("credit_score").try_cast("int").alias("credit_score"),
                    "loan_origination_date", "down_payment_assistance", "first_time_home_buyer",
                    F.col("seller_issuer_id").try_cast("int").alias("seller_issuer_id"), "agency", *keep)


def liquidation_projection(staging: DataFrame, *, report_date=None, period_col: str = "report_period", tasks: int | None = None,
                           unique: bool = False) -> DataFrame:
    """LR staging strings -> liquidation rows (10 of 15 fields kept, typed), one per loan and period; ``tasks`` as in ``dedupe_first``.

    ``unique`` says that the staging has one record per loan and period already, picked as here.
    """
    rd = (F.lit(report_date).cast("date") if report_date is not None
          else F.try_to_timestamp(F.concat(F.col(period_col), F.lit("01")), F.lit("yyyyMMdd")).cast("date"))
    keys = ["disclosure_sequence_number"] if report_date is not None else ["disclosure_sequence_number", period_col]
    if not unique:
        staging = dedupe_first(staging, keys, [F.col("liquidation_balance").try_cast(MONEY).asc_nulls_last(), ties(staging)], tasks=tasks)
    return staging.select("disclosure_sequence_number", rd.alias("report_date"),
                          F.col("issuer_id").try_cast("int").alias("issuer_id"), "cusip_number", "pool_id",
                          "agency_type", "loan_purpose",
                          F.col("original_principal_balance").try_cast(MONEY).alias("original_principal_balance"),
                          F.col("unpaid_principal_balance").try_cast(MONEY).alias("unpaid_principal_balance"),
                          F.col("liquidation_balance").try_cast(MONEY).alias("liquidation_balance"),
                          "removal_reason")


def first_records(lines: DataFrame, fields, *, key: str, month: str, balance: str, keep, tasks: int) -> DataFrame:
    """The record of each loan and month that the projections above pick, out of lines, with the fields ``keep`` as strings.

    ``lines`` has the line as ``value``, the loan as ``key``, the month of its file as ``month`` and ``source``.  The lines
    themselves are dealt by loan to ``tasks`` tasks, and all fields are read for loans that a month has
    twice only: their order is by ``balance``, then the whole record as text.  ``last`` marks the latest month of each loan.
    """
    dealt = lines.select(key, month, "source", "value").repartition(tasks, key)
    w = Window.partitionBy(key, month)
    seen = dealt.withColumn("_again", F.count(F.lit(1)).over(w) > 1)
    seen = record_fields(seen, fields, when=F.col("_again"))
    at, fields = list(fields).index(month), list(fields)
    values = F.concat(F.transform("_g", lambda v, i: F.when(i == at, F.col(month)).otherwise(v)), F.array("source"))
    record = F.map_filter(F.map_from_arrays(F.array(*[F.lit(f) for f in [*fields, "source"]]), values), lambda _, v: v.isNotNull())
    seen = seen.withColumn("_balance", F.get("_g", F.lit(fields.index(balance))).try_cast(MONEY)) \
        .withColumn("_tie", F.when(F.col("_again"), F.to_json(record))).drop("_g")  # the text that ``ties`` makes, in a short method
    first = seen.withColumn("_rn", F.row_number().over(w.orderBy(F.col("_balance").asc_nulls_last(), "_tie"))).filter("_rn = 1")
    first = first.select(key, month, "value", F.lead(month).over(Window.partitionBy(key).orderBy(month)).isNull().alias("last"))
    keep = [f for f in keep if f not in (key, month)]
    return record_fields(first, fields, keep).select(key, month, *[F.col("_g").getItem(i).alias(f) for i, f in enumerate(keep)], "last")


def fnma_static_insert(target: DataFrame, perf: DataFrame, *, key: str = "loan_identifier",
                       columns=None) -> DataFrame:
    """Earliest record per loan by reporting period, for loans not yet in the target (DISTINCT ON ... ORDER BY)."""
    cols = list(columns) if columns else target.columns
    per = mmyyyy_date(F.col("monthly_reporting_period"))
    first = dedupe_first(perf.withColumn("_per", per), [key], [F.col("_per").asc_nulls_last(), F.col("current_actual_upb").try_cast(MONEY).asc_nulls_last(), ties(perf)])
    return target.unionByName(first.join(target.select(key), key, "left_anti").select(*cols))


def fnma_monthly_insert(target: DataFrame, perf: DataFrame, *, key: str = "loan_identifier") -> DataFrame:
    """Loan-months not yet present; period text -> date; status 'XX' -> null, smallint."""
    src = perf.select(
        key, mmyyyy_date(F.col("monthly_reporting_period")).alias("reporting_date"), "servicer_name",
        "current_interest_rate", "current_actual_upb", "loan_age", "remaining_months_to_maturity",
        F.nullif(F.col("current_loan_delinquency_status"), F.lit("XX")).try_cast("smallint")
        .alias("current_loan_delinquency_status"))
    new = src.join(target.select(key, "reporting_date"), [key, "reporting_date"], "left_anti")
    return target.unionByName(new)


def state_month_from_perf(perf: DataFrame, *, min_age: int = 24, by=()) -> DataFrame:
    """Staging performance rows -> state x month x vintage counts (active, known status, seasoned), ``by`` further columns."""
    st = null_tokens(F.col("current_loan_delinquency_status"), ("XX",)).try_cast("smallint")
    p = perf.filter((F.col("current_actual_upb").try_cast("decimal(18,2)") > 0)
                    & F.col("current_loan_delinquency_status").isNotNull()
                    & (F.col("loan_age").try_cast("decimal(18,2)") >= min_age))
    return (p.groupBy(*by, mmyyyy_date(F.col("monthly_reporting_period")).alias("reporting_date"), "property_state",
                      year_from_mmyyyy(F.col("origination_date")).alias("orig_year"))
            .agg(F.count(F.lit(1)).alias("loan_count"),
                 F.sum(F.when(st >= 1, 1).otherwise(0)).cast("bigint").alias("dlq30"),
                 F.sum(F.when(st >= 3, 1).otherwise(0)).cast("bigint").alias("dlq90")))


def additive_merge(target: DataFrame, perf: DataFrame, *, keys=("reporting_date", "property_state", "orig_year")) -> DataFrame:
    """Aggregate staging to state x month x vintage and add the counts to existing rows.

    Not idempotent by nature (the reference adds on conflict): guard with the load log.
    """
    keys = list(keys)
    inc = state_month_from_perf(perf)
    u = target.select(*keys, "loan_count", "dlq30", "dlq90").unionByName(inc)
    return u.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("loan_count", "dlq30", "dlq90")])


def contributions(rows: DataFrame, counts, *, file: str) -> DataFrame:
    """What each file gives: ``counts`` (rows -> grouped counts) made per file, with the file's name.

    ``counts`` takes the rows and further grouping columns, as ``state_month_from_perf`` does.
    """
    return counts(rows, by=(file,))


def additive_replace(target: DataFrame, given: DataFrame, new: DataFrame, *, keys, values, file: str = "file_name") -> tuple[DataFrame, DataFrame]:
    """Signed additive merge: (new target, new contributions) after ``new`` replaces what its files gave before.

    ``given`` holds the counts that each file added so far, ``new`` those of the files of this load (one row
    per file and key).  The target takes the new counts plus and the old ones of the same files minus; a key whose counts all come to 0
    goes.  Only keys of the load's files change, and loading a file twice changes nothing.  A file that is
    empty now is named by a row of ``new`` with null values.
    """
    keys, values = list(keys), list(values)
    files = new.select(file).distinct()
    real = new.filter(F.col(values[0]).isNotNull())
    old = given.join(files, file, "left_semi")
    delta = real.select(*keys, *values).unionByName(old.select(*keys, *[(-F.col(v)).alias(v) for v in values]))
    merged = target.select(*keys, *values).unionByName(delta).groupBy(*keys).agg(*[F.sum(v).cast("bigint").alias(v) for v in values])
    gone = F.lit(True)
    for v in values:
        gone = gone & (F.col(v) == 0)
    return merged.filter(~gone), given.join(files, file, "left_anti").unionByName(real.select(*given.columns))


def risk_preaggregate(monthly: DataFrame, static: DataFrame, *, by=()) -> DataFrame:
    """state x month x vintage x FICO band x LTV band -> loans, 30+ and 90+ delinquent, ``by`` further columns."""
    j = monthly.join(static.drop("issuer_id"), "loan_id")
    mdq = F.col("months_delinquent")
    return (j.groupBy(*by, F.col("report_date").alias("reporting_date"), F.col("state_code").alias("property_state"),
                      F.year("loan_origination_date").alias("orig_year"),
                      rules.fico_bucket(F.col("credit_score")).alias("fico_bucket"),
                      rules.ltv_bucket(F.col("ltv")).alias("ltv_bucket"))
            .agg(F.count(F.lit(1)).alias("loan_count"),
                 F.sum(F.when(mdq >= 1, 1).otherwise(0)).cast("bigint").alias("dlq30"),
                 F.sum(F.when(mdq >= 3, 1).otherwise(0)).cast("bigint").alias("dlq90")))


def load_log_skip(candidates: DataFrame, log: DataFrame, *, force: bool = False, keys=("file_name",)) -> DataFrame:
    """Files not yet in the load log (all of them with ``force``).

    By name alone a corrected file is passed over; with a digest among ``keys`` it is loaded.
    """
    keys = list(keys)
    return candidates if force else candidates.join(log.select(*keys), keys, "left_anti")


def load_log_update(log: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rewrite the log rows of the loaded files; a load with zero records is an error."""
    checked = loaded.withColumn("rows_loaded", F.when(F.col("rows_loaded") > 0, F.col("rows_loaded")).otherwise(
        F.raise_error(F.concat(F.lit("no records found in "), F.col("file_name")))))
    return log.join(checked.select("file_name"), "file_name", "left_anti").unionByName(checked.select(*log.columns))


def issuer_group_update(issuer_info: DataFrame, monthly: DataFrame, *, report_date=None, latest: bool = False,
                        edges=rules.ISSUER_GROUP_EDGES, top: str = rules.ISSUER_GROUP_TOP) -> DataFrame:
    """Issuer size band by loan count in a month; issuers with no loans keep their band.

    ``latest`` takes each issuer's latest month in ``monthly``: what updates month after month end with.
    """
    m = monthly if report_date is None else monthly.filter(F.col("report_date") == F.lit(report_date).cast("date"))
    if latest:
        counts = dedupe_first(m.groupBy("issuer_id", "report_date").agg(F.count(F.lit(1)).alias("_n")), ["issuer_id"],
                              [F.desc("report_date")]).select("issuer_id", "_n")
    else:
        counts = m.groupBy("issuer_id").agg(F.count(F.lit(1)).alias("_n"))
    new = counts.select(F.col("issuer_id").alias("_iid"), rules.issuer_group(F.col("_n"), edges, top).alias("_grp"))
    j = issuer_info.join(new, issuer_info.issuer_number == new._iid, "left")
    return j.withColumn("issuer_group", F.coalesce("_grp", "issuer_group")).drop("_iid", "_grp")


def mf_monthly_build(mf: DataFrame, *, report_date, legacy_age: bool = False) -> DataFrame:
    """Multifamily loan-month: dates from ``yyyyMMdd`` (bad -> null), status label, loan age in months.

    ``legacy_age=True`` reproduces the reference's formula, which uses the year
    difference twice (13 x years) and ignores the month.
    """
    rd = F.lit(report_date).cast("date")
    fp = F.try_to_timestamp(F.col("first_payment_date"), F.lit("yyyyMMdd")).cast("date")
    mt = F.try_to_timestamp(F.col("maturity_date_of_loan"), F.lit("yyyyMMdd")).cast("date")
    md = F.col("months_delinquent").try_cast("double")
    dy = F.year(rd) - F.year(fp)
    age = dy * 13 if legacy_age else dy * 12 + F.month(rd) - F.month(fp)
    return mf.select("disclosure_sequence_number", "unpaid_principal_balance", "issuer_number",
                     fp.alias("first_payment_date"), mt.alias("maturity_date_of_loan"), "months_delinquent",
                     F.when(md == 0, "Current").otherwise("Delinquent").alias("delinquency_status"),
                     "removal_reason", "green_status", "affordable_status", rd.alias("report_date"),
                     age.alias("loan_age"))


def mf_static_build(mf: DataFrame) -> DataFrame:
    """Multifamily static: zip to 5 characters without a trailing '.0', MSA cleaned, first payment date parsed."""
    from loanlens.functions.clean import strip_trailing_zero_decimal, zip5

    return mf.select("disclosure_sequence_number", "issuer_number", "property_state",
                     zip5(F.col("property_zip")).alias("property_zip"),
                     strip_trailing_zero_decimal(F.col("msa")).alias("msa"), "property_name", "insurance_type",
                     "security_interest_rate", "original_principal_balance",
                     F.try_to_timestamp(F.col("first_payment_date"), F.lit("yyyyMMdd")).cast("date")
                     .alias("first_payment_date"), "seller_issuer_id", "security_rpb", "pre_payment_penalty_flag")


def m_issuer_rows(mf_lines: DataFrame) -> DataFrame:
    """Issuer part of M records (fields 9..16), first write wins per issuer number."""
    from loanlens.sources.layouts import M_FIELDS, M_ISSUER_POSITIONS

    cols = [M_FIELDS[i] for i in M_ISSUER_POSITIONS]
    return dedupe_first(mf_lines.select(*cols), ["issuer_number"], [F.col("issuer_name").asc_nulls_last()])
