"""The generated tables seen as staffing days and provider rows.

The generated tables hold no nulls, unknown or repeated facilities, or hours in
hundredths, so these come from rules on the keys.
"""

from pyspark.sql import functions as F

from wardstat import schemas as S
from wardstat.plans import gold as G
from wardstat.plans.serving import in_state


_SCHEMAS = {}


def table(spark, sf_dir, name):
    """One generated table. Its schema is looked up once, not per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _suppliers_with_state(spark, sf_dir):
    states = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("STATE"))
    return table(spark, sf_dir, "supplier").join(
        states, F.col("s_nationkey") == F.col("n_nationkey"))


def facilities(spark, sf_dir):
    """PROVNUM, PROVNAME, STATE of every supplier; each seventh is listed twice, the
    second time under a longer name."""
    names = F.when(F.col("s_suppkey") % 7 == 0, F.array("s_name", F.concat("s_name", F.lit(" II")))).otherwise(
        F.array("s_name"))
    return _suppliers_with_state(spark, sf_dir).select(
        F.col("s_suppkey").cast("string").alias("PROVNUM"), F.explode(names).alias("PROVNAME"), "STATE")


def _day_supplier():
    """Number of the supplier that a line is a day of: unknown or null by rules on its keys."""
    return F.when(F.col("l_orderkey") % 89 != 3, F.col("l_suppkey") + F.when(
        F.col("l_partkey") % 97 == 5, 5_000_000).otherwise(0))


def _day_columns():
    hours = {
        "Hrs_RN": F.when(F.col("l_quantity") != 13, F.col("l_quantity")),
        "Hrs_LPN": F.when(F.col("l_returnflag") != "A", F.col("l_quantity") * 0.57),
        "Hrs_CNA": F.when(F.col("l_linenumber") != 7, F.col("l_linenumber") * 4.01),
    }
    split = {
        f"{name}_{kind}": F.when(F.col("l_linestatus") == status, value)
        for kind, status in (("emp", "F"), ("ctr", "O"))
        for name, value in hours.items()
    }
    census = F.floor(F.col("l_extendedprice") / 1000).cast("double")
    return {
        S.WORK_DATE: F.col("l_shipdate").cast("date"),
        **hours,
        **split,
        S.CENSUS: F.when(F.col("l_linenumber") != 1, census),
    }


def days(spark, sf_dir):
    """One row per line item, with the facility number only."""
    columns = [c.alias(n) for n, c in _day_columns().items()]
    return table(spark, sf_dir, "lineitem").select(_day_supplier().cast("string").alias("PROVNUM"), *columns)


def state_days(spark, sf_dir, state):
    """The days of one state's facilities. The join is on the number as it is stored, so
    that the lines can be filtered where they are scanned."""
    numbers = in_state(_suppliers_with_state(spark, sf_dir), state).select("s_suppkey")
    columns = [c.alias(n) for n, c in _day_columns().items()]
    lines = table(spark, sf_dir, "lineitem").join(
        numbers, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    # The lines of a facility of the state that a rule gives to another one are none of its days.
    return lines.where(_day_supplier() == F.col("l_suppkey")).select(
        F.col("l_suppkey").cast("string").alias("PROVNUM"), *columns)


def pbj(spark, sf_dir):
    """The daily file as delivered: facility name and state in every row that has them.

    The join is on the number, PROVNUM is made from it afterwards. Were PROVNUM
    itself the join key, Spark would aggregate in place after a shuffled join
    and a hot facility would stay whole in one task. This way it may split the
    hot side of the join, and it reduces before it shuffles again. The lines
    travel as they are; the day columns are made after the join.
    """
    lines = table(spark, sf_dir, "lineitem").withColumn("number", _day_supplier())
    named = lines.join(
        _suppliers_with_state(spark, sf_dir), F.col("number") == F.col("s_suppkey"), "left")
    flat = named.select(
        F.col("number").cast("string").alias("PROVNUM"),
        F.col("s_name").alias("PROVNAME"),
        "STATE", *[c.alias(n) for n, c in _day_columns().items()])
    return flat.select(*S.FACILITY_KEYS, S.WORK_DATE, *S.PBJ_NUMBERS)


def provider_rows(spark, sf_dir):
    """Provider model rows with repeated facilities (other bed count) and with
    facilities that have no staffing days."""
    copies = F.expr("""
        CASE WHEN s_suppkey % 10 = 0
             THEN array(struct(s_suppkey AS k, 0 AS dup), struct(s_suppkey AS k, 1 AS dup))
             WHEN s_suppkey % 10 = 5
             THEN array(struct(s_suppkey AS k, 0 AS dup),
                        struct(s_suppkey + 1000000L AS k, 0 AS dup))
             ELSE array(struct(s_suppkey AS k, 0 AS dup)) END""")
    return (
        _suppliers_with_state(spark, sf_dir)
        .select("s_name", "STATE", F.inline(copies))
        .selectExpr(
            "cast(k AS string) AS PROVNUM",
            "s_name AS PROVNAME",
            "STATE",
            "cast(CASE WHEN k % 11 = 0 THEN 0 ELSE 40 + (k % 9) * 10 + dup END AS double)"
            " AS CERTIFIED_BEDS",
            "cast(CASE WHEN k % 17 <> 3 THEN 20 + (k * 7) % 90 END AS double) AS AVG_RESIDENTS",
            "cast(CASE WHEN k % 13 <> 0 THEN 1 + k % 5 END AS double) AS OVERALL_RATING",
            "cast(CASE WHEN k % 13 <> 0 AND k % 4 <> 1 THEN 1 + (k * 3) % 5 END AS double)"
            " AS HEALTH_RATING",
            "cast(CASE WHEN k % 13 <> 0 AND k % 6 <> 2 THEN 1 + (k * 2) % 5 END AS double)"
            " AS STAFFING_RATING",
        )
    )


def provider_copies(spark, sf_dir):
    """Provider rows with a verbatim copy of those whose number ends in 0."""
    twice = F.when(F.col("PROVNUM").endswith("0"), 2).otherwise(1)
    rows = provider_rows(spark, sf_dir)
    return rows.select("*", F.explode(F.sequence(F.lit(1), twice)).alias("_copy")).drop("_copy")


def provider_file(spark, sf_dir):
    """Provider rows under the delivered headers, with columns silver drops."""
    headers = {t: s for s, t in {**S.PROVIDER_TEXT, **S.PROVIDER_NUMBERS}.items()}
    rows = provider_rows(spark, sf_dir)
    return rows.select(
        *[F.col(c).alias(headers[c]) for c in rows.columns],
        F.when(F.col("OVERALL_RATING").isNull(), "18").alias("Overall Rating Footnote"),
        F.when(F.col("CERTIFIED_BEDS") == 0, "SFF").alias("Special Focus Status"),
    )


def daily(spark, sf_dir):
    return G.prepare_daily(days(spark, sf_dir))


def _days_and_facilities(spark, sf_dir, state):
    """Prepared days and named facilities, of all states or of one."""
    named = facilities(spark, sf_dir)
    if state is None:
        return daily(spark, sf_dir), named
    return G.prepare_daily(state_days(spark, sf_dir, state)), in_state(named, state)


def rollup(spark, sf_dir, state=None):
    return G.monthly_rollup(*_days_and_facilities(spark, sf_dir, state))


def staffing(spark, sf_dir, state=None):
    return G.staffing_metrics(rollup(spark, sf_dir, state))


def volume(spark, sf_dir, state=None):
    return G.patient_volume(*_days_and_facilities(spark, sf_dir, state))


def providers(spark, sf_dir):
    return G.unique_providers(provider_rows(spark, sf_dir))


def mean_ratios(spark, sf_dir):
    return G.facility_mean_ratio(staffing(spark, sf_dir))


def facility(spark, sf_dir):
    return G.facility_metrics(providers(spark, sf_dir), mean_ratios(spark, sf_dir))


def quality(spark, sf_dir):
    return G.quality_metrics(providers(spark, sf_dir))


def served(spark, sf_dir, state=None):
    """Staffing, facility and quality tables built on the same two inputs. Here a
    facility never changes its state, so its ratio needs the days of one."""
    monthly, unique = staffing(spark, sf_dir, state), providers(spark, sf_dir)
    facility_table = G.facility_metrics(unique, G.facility_mean_ratio(monthly))
    return tuple(in_state(t, state) for t in (monthly, facility_table, G.quality_metrics(unique)))
