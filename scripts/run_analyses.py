"""Cluster entry point: raw feeds -> incident table -> analyses.

    spark-submit scripts/run_analyses.py \
        --arrests s3://bucket/arrests/ --complaints s3://bucket/complaints/ \
        --demographics s3://bucket/demographics/ --regions s3://bucket/regions.csv \
        --out s3://bucket/analysis/ [--years 2006-2018] [--input-bytes 100T]

The raw JSON is parsed exactly once (fixed schema, no inference) into the
``RECORD_TYPE / Year`` partitioned parquet table; every analysis then reads
that table, so record-type and year filters prune directories and only the
needed columns are decoded.  Results are small tables written as parquet.
Lineage is cut with checkpoints in the folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from blotter.functions.dates import clock_hour  # noqa: E402
from blotter.operators.correspondence import ca_biplot, correspondence  # noqa: E402
from blotter.operators.crosstab import crosstab_long, pair_counts  # noqa: E402
from blotter.operators.demographics import assemble_demographics, unpivot_years  # noqa: E402
from blotter.operators.harmonize import harmonize, record_type, since  # noqa: E402
from blotter.operators.ranking import top_values  # noqa: E402
from blotter.operators.regression import (attach_demographics, correlations, elastic_net, ols_tests,  # noqa: E402
                                          region_year_facts)
from blotter.operators.sampling import stratified_sample_hash  # noqa: E402
from blotter.operators.scaling import minmax, zscore  # noqa: E402
from blotter.operators.spatial import grid_counts, kernel_density, region_year_counts, tagged_counts  # noqa: E402
from blotter.operators.temporal import (daily_pivot, hourly_pivot, monthly_resample, pivot_to_long,  # noqa: E402
                                        seasonal_profile)
from blotter.schema import (BOROUGH_CODES, DEMOGRAPHIC_MEASURES, HOURLY_EXCLUDED_OFFENCES,  # noqa: E402
                            RACE_FRACTIONS, TOP_K)
from blotter.session import materialize, recommended_conf  # noqa: E402
from blotter.sources import (read_arrests, read_complaints, read_demographics_wide, read_regions,  # noqa: E402
                             read_table, write_incidents)

_UNITS = {"K": 1 << 10, "M": 1 << 20, "G": 1 << 30, "T": 1 << 40}


def _bytes(text: str) -> int:
    return int(float(text[:-1]) * _UNITS[text[-1].upper()]) if text[-1].upper() in _UNITS else int(text)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--arrests", nargs="+", required=True)
    ap.add_argument("--complaints", nargs="+", required=True)
    ap.add_argument("--demographics", required=True, help="folder with one wide CSV per measure")
    ap.add_argument("--regions", required=True)
    ap.add_argument("--regions-format", default="csv")
    ap.add_argument("--out", required=True)
    ap.add_argument("--years", default="2006-2018")
    ap.add_argument("--input-bytes", default="100T")
    ap.add_argument("--executors", type=int, default=1000)
    ap.add_argument("--cores", type=int, default=8)
    ap.add_argument("--cell", type=float, default=0.005)
    ap.add_argument("--boroughs", default=",".join(BOROUGH_CODES.values()),
                    help="comma-separated region names kept for the borough-year facts")
    ap.add_argument("--checkpoint-dir", help="shared folder for written intermediates "
                                             "(default: the session's spark.checkpoint.dir)")
    ap.add_argument("--sub-demographics", help="folder with one wide CSV per measure and sub-region")
    ap.add_argument("--since", default="2017-01-01", help="start of the density and heat layers")
    ap.add_argument("--bandwidth", type=float, default=0.005)
    a = ap.parse_args()

    builder = SparkSession.builder.appName("blotter-analyses")
    if a.checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", a.checkpoint_dir)
    for k, v in recommended_conf(_bytes(a.input_bytes), a.executors, a.cores).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    out = a.out.rstrip("/")
    lo, hi = (int(y) for y in a.years.split("-"))
    years = [str(y) for y in range(lo, hi + 1)]

    def save(df, name):
        df.write.mode("overwrite").parquet(f"{out}/{name}")

    # 1. parse once, persist partitioned
    write_incidents(harmonize(read_arrests(spark, a.arrests), read_complaints(spark, a.complaints)),
                    f"{out}/incidents")
    inc = read_table(spark, f"{out}/incidents")
    complaints = record_type(inc, "C")

    # 2. the five crosstabs and their correspondence analyses
    for field in ("PREM_TYP_DESC", "SUSP_AGE_GROUP", "SUSP_SEX", "BORO_NM", "SUSP_RACE"):
        counts = materialize(pair_counts(complaints, field, "OFNS_DESC"))
        offences = top_values(counts, "OFNS_DESC", TOP_K, weight="n")
        rows = top_values(counts, field, TOP_K, weight="n")
        cells = crosstab_long(counts, field, "OFNS_DESC", offences, row_filter=rows, weight="n")
        ca = correspondence(cells, field, "OFNS_DESC")
        save(ca.coordinates, f"ca_coordinates/{field}")
        save(ca.scree, f"ca_scree/{field}")
        save(ca_biplot(ca.coordinates), f"ca_biplot/{field}")

    # 3. borough-year facts, correlations, hypothesis tests
    demo_dir = a.demographics.rstrip("/")
    parts = {m: unpivot_years(read_demographics_wide(spark, f"{demo_dir}/{m}.csv", years), m, years)
             for m in DEMOGRAPHIC_MEASURES}
    facts = materialize(region_year_facts(inc, assemble_demographics(parts), years,
                                          a.boroughs.split(",")))
    save(correlations(facts, "crime_count"), "correlations")
    save(elastic_net(facts, "crime_count", ["unemployment_rate"]), "elastic_net")
    tests = [(f"crime_count~{m}", m, None) for m in DEMOGRAPHIC_MEASURES[:4]] + \
        [(f"crime_count~{m}+population", m, "population") for m in DEMOGRAPHIC_MEASURES[:4]]
    save(ols_tests(facts, "crime_count", tests), "ols_tests")

    # 4. sub-region tagging and counts
    regions = read_regions(spark, a.regions, fmt=a.regions_format)
    pts = complaints.filter(F.col("Year").isin([int(y) for y in years]) & F.col("Lat_Lon").isNotNull())
    counts = tagged_counts(pts, regions, by=["Year"], count=F.count("CMPLNT_NUM"))
    sub_counts = materialize(region_year_counts(counts, weight="n"))
    save(sub_counts, "region_counts")
    if a.sub_demographics:
        sub_dir = a.sub_demographics.rstrip("/")
        sub = assemble_demographics({m: unpivot_years(read_demographics_wide(
            spark, f"{sub_dir}/{m}.csv", years, entity_alias="Sub-Borough Area"), m, years)
            for m in DEMOGRAPHIC_MEASURES})
        sub_facts = materialize(attach_demographics(sub_counts, sub))
        save(correlations(sub_facts, "crime_count"), "subregion_correlations")
        save(ols_tests(sub_facts, "crime_count", tests), "subregion_ols_tests")
        save(elastic_net(sub_facts, "crime_count", ["unemployment_rate"]), "subregion_elastic_net")

    # 5. temporal profiles of arrests and complaints
    arrests = record_type(inc, "A")
    days = materialize(pair_counts(arrests, "Date", "OFNS_DESC"))
    offences = top_values(days, "OFNS_DESC", TOP_K, weight="n")
    daily = materialize(daily_pivot(days, "Date", "OFNS_DESC", offences, weight="n"))
    save(monthly_resample(daily, "Date", offences), "monthly")
    for part, last in (("day", 28), ("month", None)):
        profile = pivot_to_long(seasonal_profile(daily, "Date", offences, part, last), part, offences, "OFNS_DESC")
        save(zscore(profile, "n", "OFNS_DESC", ddof=1), f"{part}_profile")
    hours = materialize(pair_counts(complaints, clock_hour("CMPLNT_FR_TM").alias("hour"), "OFNS_DESC"))
    offences = top_values(hours, "OFNS_DESC", TOP_K, weight="n")
    shown = [o for o in offences if o not in HOURLY_EXCLUDED_OFFENCES]
    by_hour = hourly_pivot(hours, "hour", "OFNS_DESC", offences, "hour", exclude=HOURLY_EXCLUDED_OFFENCES, weight="n")
    save(minmax(pivot_to_long(by_hour, "hour", shown, "OFNS_DESC"), "n", "OFNS_DESC"), "hour_profile")

    # 6. density surfaces and a stratified sample of recent arrests
    recent = since(arrests, a.since)
    for key in ("OFNS_DESC", "SUSP_RACE"):
        grid = materialize(grid_counts(recent.filter(F.col(key).isNotNull()), "Longitude", "Latitude", a.cell, by=[key]))
        top = top_values(grid, key, TOP_K, weight="n")
        save(kernel_density(grid.filter(F.col(key).isin(top)), a.cell, a.bandwidth, by=[key]), f"density/{key}")
    save(stratified_sample_hash(recent, "SUSP_RACE", RACE_FRACTIONS, "CMPLNT_NUM"), "sample")
    spark.stop()


if __name__ == "__main__":
    main()
