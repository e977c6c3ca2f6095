"""The questions the dashboard asks, each one plan over the gold tables."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat import schemas as S
from wardstat.functions.metrics import exact_mean, exact_sum, zero_if_null
from wardstat.operators.columns import coerce_numeric, require_columns, standardize_columns
from wardstat.operators.ranking import top_k, top_k_of_each
from wardstat.operators.reshape import aggregates_as_rows, to_long

ALL_STATES = "All States"

# Heatmap columns in display order.
QUALITY_MEASURES = (
    "AVG_QUALITY_SCORE", "AVG_OVERALL_RATING", "AVG_HEALTH_RATING", "AVG_STAFFING_RATING")
STAFFING_MEASURES = (
    "TOTAL_NURSE_HOURS", "RN_HOURS", "LPN_HOURS", "CNA_HOURS", "EMPLOYEE_HOURS",
    "CONTRACT_HOURS")


def serving_frame(df, table):
    """A gold table as served: standard names, numeric columns as numbers."""
    return coerce_numeric(standardize_columns(df), S.GOLD_NUMBERS[table])


def in_state(df, state=None):
    """Rows of one state. On a gold table this prunes whole partitions."""
    if state in (None, ALL_STATES) or "STATE" not in df.columns:
        return df
    return df.filter(F.col("STATE") == state)


def state_list(facility):
    return facility.select("STATE").dropna().distinct().orderBy("STATE")


def _total(name):
    """Sum in which nothing to add is 0."""
    return zero_if_null(exact_sum(name))


def kpi_cards(facility, staffing, quality):
    """One row with the four key figures; a mean over nothing is null.

    Each table is reduced to one row on its own; the three rows are then folded
    into one.
    """
    cards = (
        facility.agg(
            F.count_distinct("PROVNUM").alias("TOTAL_FACILITIES"),
            exact_mean("OCCUPANCY_RATE").alias("AVERAGE_OCCUPANCY_RATE"))
        .unionByName(
            staffing.agg(_total("TOTAL_NURSE_HOURS").alias("TOTAL_NURSE_HOURS")),
            allowMissingColumns=True)
        .unionByName(
            quality.agg(exact_mean("FACILITY_QUALITY_SCORE").alias("AVERAGE_QUALITY_SCORE")),
            allowMissingColumns=True)
    )
    names = ("TOTAL_FACILITIES", "TOTAL_NURSE_HOURS", "AVERAGE_OCCUPANCY_RATE",
             "AVERAGE_QUALITY_SCORE")
    return cards.agg(*[F.max(n).alias(n) for n in names])


#: Log of the number of a sketch's cells; an estimate is off by about one in the root of that number.
SKETCH_BITS = 12


def facility_sketches(facility, by="STATE"):
    """``STATE, FACILITIES``: a sketch of the facility numbers of each state, a few kilobytes each.

    Save them once: the facilities of any states together are counted from their
    sketches, without reading the states again or any other.
    """
    sketch = F.hll_sketch_agg("PROVNUM", F.lit(SKETCH_BITS)).alias("FACILITIES")
    return facility.groupBy(by).agg(sketch)


def estimated_facilities(sketches):
    """One row: the number of different facilities in all the sketches, about."""
    return sketches.agg(F.coalesce(
        F.hll_sketch_estimate(F.hll_union_agg("FACILITIES")), F.lit(0).cast("long")).alias("TOTAL_FACILITIES"))


def hours_by_staff_type(staffing):
    measures = {s: _total(f"{s}_HOURS") for s in S.STAFF_TYPES}
    return aggregates_as_rows(staffing, measures, "STAFF_TYPE", "HOURS")


def employee_vs_contract(staffing):
    measures = {  # fixed values: labels as the charts show them
        "Employee Hours": _total("EMPLOYEE_HOURS"),
        "Contract Hours": _total("CONTRACT_HOURS"),
    }
    return aggregates_as_rows(staffing, measures, "STAFF_TYPE", "HOURS")


def average_ratings(quality):
    measures = {  # fixed values: labels as the charts show them
        "Overall Rating": F.avg("OVERALL_RATING"),
        "Health Rating": F.avg("HEALTH_RATING"),
        "Staffing Rating": F.avg("STAFFING_RATING"),
    }
    return aggregates_as_rows(quality, measures, "RATING_TYPE", "AVERAGE_SCORE")


def top_occupancy(facility, k=10):
    return top_k(facility, "OCCUPANCY_RATE", k)


def top_pressure(facility, k=10):
    return top_k(facility, "STAFFING_PRESSURE_INDEX", k)


def top_quality(quality, k=10):
    return top_k(quality, "FACILITY_QUALITY_SCORE", k)


def top_volume(volume, k=10):
    return top_k(volume, "TOTAL_PATIENT_DAYS", k)


def state_tops(table, metric, k=10):
    """The top list of every state at once."""
    return top_k_of_each(table, metric, "STATE", k)


def mean_nurse_ratio(staffing):
    """Mean monthly ratio per facility; rows with a null key take no part."""
    rows = staffing.dropna(subset=["NURSE_TO_PATIENT_RATIO", *S.FACILITY_KEYS])
    mean = exact_mean("NURSE_TO_PATIENT_RATIO").alias("NURSE_TO_PATIENT_RATIO")
    return rows.groupBy(*S.FACILITY_KEYS).agg(mean)


def top_nurse_ratio(staffing, k=10):
    return top_k(mean_nurse_ratio(staffing), "NURSE_TO_PATIENT_RATIO", k)


def quality_heatmap(quality):
    """Mean score and ratings per state, in state order."""
    return quality.dropna(subset=["STATE"]).groupBy("STATE").agg(
        exact_mean("FACILITY_QUALITY_SCORE").alias("AVG_QUALITY_SCORE"),
        F.avg("OVERALL_RATING").alias("AVG_OVERALL_RATING"),
        F.avg("HEALTH_RATING").alias("AVG_HEALTH_RATING"),
        F.avg("STAFFING_RATING").alias("AVG_STAFFING_RATING"),
    ).orderBy("STATE")


def staffing_heatmap(staffing):
    """Hours per state, in state order; nothing to add is 0."""
    return staffing.dropna(subset=["STATE"]).groupBy("STATE").agg(
        *[_total(c).alias(c) for c in STAFFING_MEASURES]).orderBy("STATE")


@dataclass(frozen=True)
class Dashboard:
    """The four gold tables and every question asked of them."""

    staffing: DataFrame
    facility: DataFrame
    quality: DataFrame
    volume: DataFrame

    @classmethod
    def over(cls, tables):
        """``tables`` maps gold names to DataFrames, typed or all text."""
        served = {name: serving_frame(tables[name], name) for name in S.GOLD_TABLES}
        require_columns(served["facility_metrics"], ["STATE", "PROVNUM", "PROVNAME"])
        return cls(
            staffing=served["staffing_metrics"],
            facility=served["facility_metrics"],
            quality=served["quality_metrics"],
            volume=served["top_patient_volume"],
        )

    def for_state(self, state):
        """The same questions for one state. The volume list stays a selection
        from the overall top ten, as that table holds no more."""
        return replace(self, **{
            name: in_state(getattr(self, name), state)
            for name in ("staffing", "facility", "quality", "volume")
        })

    def states(self):
        return state_list(self.facility)

    def kpi_cards(self):
        return kpi_cards(self.facility, self.staffing, self.quality)

    def hours_by_staff_type(self):
        return hours_by_staff_type(self.staffing)

    def employee_vs_contract(self):
        return employee_vs_contract(self.staffing)

    def average_ratings(self):
        return average_ratings(self.quality)

    def top_occupancy(self, k=10):
        return top_occupancy(self.facility, k)

    def top_pressure(self, k=10):
        return top_pressure(self.facility, k)

    def top_quality(self, k=10):
        return top_quality(self.quality, k)

    def top_nurse_ratio(self, k=10):
        return top_nurse_ratio(self.staffing, k)

    def top_volume(self, k=10):
        return top_volume(self.volume, k)

    def quality_heatmap(self):
        return quality_heatmap(self.quality)

    def staffing_heatmap(self):
        return staffing_heatmap(self.staffing)

    def quality_heatmap_long(self):
        return to_long(self.quality_heatmap(), "STATE", QUALITY_MEASURES)

    def staffing_heatmap_long(self):
        return to_long(self.staffing_heatmap(), "STATE", STAFFING_MEASURES)
