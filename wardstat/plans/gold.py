"""The four gold tables as functions from DataFrame to DataFrame."""

from pyspark.sql import functions as F

from wardstat import schemas as S
from wardstat.functions.conversions import to_double, to_work_date
from wardstat.functions.metrics import (
    exact_mean,
    exact_sum,
    guarded_ratio,
    mean_of_present,
    null_safe_sum,
)
from wardstat.operators.columns import select_renamed
from wardstat.operators.profiling import first_row_per_key
from wardstat.operators.ranking import top_k
from wardstat.sources.sinks import gathered

MONTH_KEYS = ("YEAR", "MONTH")
CENSUS_DAYS = "CENSUS_DAYS"


def prepare_daily(pbj):
    """Type the daily rows and add ``YEAR``, ``MONTH``, ``TOTAL_NURSE_HOURS``."""
    types = {f.name: f.dataType for f in pbj.schema}
    typed = {c: to_double(F.col(c)) for c in S.PBJ_NUMBERS}
    typed[S.WORK_DATE] = to_work_date(F.col(S.WORK_DATE), types[S.WORK_DATE])
    return pbj.withColumns(typed).withColumns({
        "YEAR": F.year(S.WORK_DATE),
        "MONTH": F.month(S.WORK_DATE),
        "TOTAL_NURSE_HOURS": null_safe_sum(*S.HOURS),
    })


def gathered_days(days):
    """The days of a facility and month brought together, a hot month split; for days in any order.

    A task that reads days as they lie may hold a row of nearly every facility and
    month: its aggregate then grows with the task, spills, and sends its wide rows
    on almost one for one. Here the days travel once as they are. The month is a
    column of its own so that Spark reduces each part before it shuffles the sums.
    """
    types = {f.name: f.dataType for f in days.schema}
    month = F.trunc(to_work_date(F.col(S.WORK_DATE), types[S.WORK_DATE]), "month")
    return gathered(days.withColumn("_month", month), ["PROVNUM", "_month"]).drop("_month")


def _per_facility(daily, facilities, extra_keys, measures):
    """Aggregate ``daily`` per facility and ``extra_keys``.

    Daily files carry name and state in every row. Where a source keeps them in
    a table of its own, pass it as ``facilities``: the days are then reduced by
    PROVNUM first and only the reduced rows are joined, so the days never shuffle
    for the join, however hot one facility is. Days of a facility that the table
    does not hold, and days without number, stay, with null name and state. Of a
    facility listed twice the smallest row counts.
    """
    if facilities is None:
        return daily.groupBy(*S.FACILITY_KEYS, *extra_keys).agg(*measures)
    reduced = daily.groupBy("PROVNUM", *extra_keys).agg(*measures)
    named = reduced.join(unique_providers(facilities.select(*S.FACILITY_KEYS)), "PROVNUM", "left")
    return named.select(*S.FACILITY_KEYS, *[c for c in reduced.columns if c != "PROVNUM"])


def monthly_rollup(daily, facilities=None):
    """Prepared days summed per facility and month.

    ``RN_HOURS``, ``LPN_HOURS`` and ``CNA_HOURS`` are null when every day is
    null; the totals count null as 0. ``CENSUS_DAYS`` lets the patient volume be
    derived from this table, so that a gold run scans the days once.
    """
    return _per_facility(daily, facilities, MONTH_KEYS, [
        exact_sum("TOTAL_NURSE_HOURS").alias("TOTAL_NURSE_HOURS"),
        exact_mean(S.CENSUS).alias("AVG_PATIENT_CENSUS"),
        *[exact_sum(f"Hrs_{s}").alias(f"{s}_HOURS") for s in S.STAFF_TYPES],
        exact_sum(null_safe_sum(*S.EMPLOYEE_HOURS)).alias("EMPLOYEE_HOURS"),
        exact_sum(null_safe_sum(*S.CONTRACT_HOURS)).alias("CONTRACT_HOURS"),
        exact_sum(S.CENSUS).alias(CENSUS_DAYS),
    ])


def staffing_metrics(rollup):
    """Gold: the monthly roll-up with its ratios."""
    return rollup.drop(CENSUS_DAYS).withColumns({
        "NURSE_TO_PATIENT_RATIO": guarded_ratio("TOTAL_NURSE_HOURS", "AVG_PATIENT_CENSUS"),
        "EMPLOYEE_STAFF_PERCENT": guarded_ratio("EMPLOYEE_HOURS", "TOTAL_NURSE_HOURS", 100),
        "CONTRACT_STAFF_PERCENT": guarded_ratio("CONTRACT_HOURS", "TOTAL_NURSE_HOURS", 100),
    })


def facility_mean_ratio(staffing):
    """Unweighted mean of the monthly ratios per facility."""
    mean = exact_mean("NURSE_TO_PATIENT_RATIO").alias("AVG_STAFFING_RATIO")
    return staffing.groupBy("PROVNUM").agg(mean)


def provider_model(raw):
    """Raw provider headers, or their sanitised form, to the model columns."""
    return select_renamed(raw, text=S.PROVIDER_TEXT, numbers=S.PROVIDER_NUMBERS)


def top_occupancy(providers, daily, facilities=None, k=10):
    """The fullest facilities with all their metrics.

    Occupancy needs no staffing: the providers are ranked first, and only the
    days of those ``k`` are read on, so the broadcast holds at most ``k`` numbers.
    """
    top = top_k(occupancy(providers), "OCCUPANCY_RATE", k)
    few = daily.join(F.broadcast(top.select("PROVNUM")), "PROVNUM", "left_semi")
    ratios = facility_mean_ratio(staffing_metrics(monthly_rollup(few, facilities)))
    return top_k(facility_metrics(top.drop("OCCUPANCY_RATE"), ratios), "OCCUPANCY_RATE", k)


def unique_providers(model):
    """One row per facility; the same row for every table built on it."""
    return first_row_per_key(model, ["PROVNUM"])


def occupancy(providers):
    """Providers with their occupancy, which needs no staffing."""
    return providers.withColumn(
        "OCCUPANCY_RATE", guarded_ratio("AVG_RESIDENTS", "CERTIFIED_BEDS", 100))


def facility_metrics(providers, mean_ratios):
    """Gold: occupancy and staffing pressure. Facilities without staffing stay,
    with a null ratio and a pressure of 0."""
    return (
        occupancy(providers)
        .join(mean_ratios, "PROVNUM", "left")
        .withColumn(
            "STAFFING_PRESSURE_INDEX", guarded_ratio("AVG_RESIDENTS", "AVG_STAFFING_RATIO"))
    )


def quality_metrics(providers):
    """Gold: the three ratings and their mean."""
    return providers.select(*S.FACILITY_KEYS, *S.RATINGS).withColumn(
        "FACILITY_QUALITY_SCORE", mean_of_present(*S.RATINGS))


def patient_volume(daily, facilities=None, census=S.CENSUS):
    """Patient days per facility over the whole period, from the days or, with
    ``census=CENSUS_DAYS``, from the monthly roll-up."""
    total = exact_sum(census).alias("TOTAL_PATIENT_DAYS")
    return _per_facility(daily, facilities, (), [total])


def top_patient_volume(volume, k=10):
    """Gold: the ``k`` largest; a facility without any census ranks last."""
    return top_k(volume, "TOTAL_PATIENT_DAYS", k, keep_null=True)
