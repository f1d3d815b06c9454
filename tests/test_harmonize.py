"""NRM1 and its parts on hand-made rows (NULL rules, code map, dates)."""

from pyspark.sql import functions as F

from blotter.functions.dates import civil_date, clock_hour
from blotter.operators.harmonize import harmonize
from blotter.schema import ARREST_SCHEMA, COMPLAINT_SCHEMA, INCIDENT_COLUMNS


def _arrest(**kv):
    row = {f.name: None for f in ARREST_SCHEMA.fields}
    row.update(kv)
    return row


def _complaint(**kv):
    row = {f.name: None for f in COMPLAINT_SCHEMA.fields}
    row.update(kv)
    return row


def _frames(spark, arrests, complaints):
    a = spark.createDataFrame([tuple(r[f.name] for f in ARREST_SCHEMA.fields) for r in arrests], ARREST_SCHEMA)
    c = spark.createDataFrame([tuple(r[f.name] for f in COMPLAINT_SCHEMA.fields) for r in complaints],
                              COMPLAINT_SCHEMA)
    return a, c


def test_harmonize_rules(spark):
    arrests = [
        _arrest(ARREST_KEY="a1", ARREST_DATE="01/02/2019", ARREST_BORO="K", AGE_GROUP="25-44",
                PERP_SEX="M", PERP_RACE="WHITE", OFNS_DESC="ROBBERY", PD_CD="1", Latitude="40.7",
                Longitude="-73.9"),
        _arrest(ARREST_KEY="a2", ARREST_DATE="1/2/2019", ARREST_BORO="X", AGE_GROUP="<18"),
        _arrest(ARREST_KEY="a3", ARREST_DATE="13/45/2019", ARREST_BORO=None, AGE_GROUP="65+",
                Latitude="junk"),
        _arrest(ARREST_KEY="a4", ARREST_DATE="01/02/2019", AGE_GROUP="UNKNOWN"),   # illegal for arrests
        _arrest(ARREST_KEY="a5", ARREST_DATE="01/02/2019", AGE_GROUP=None),        # NULL rejected
    ]
    complaints = [
        _complaint(CMPLNT_NUM="c1", CMPLNT_FR_DT="12/31/2018", CMPLNT_FR_TM="23:59:00", BORO_NM="QUEENS",
                   SUSP_AGE_GROUP=None, SUSP_SEX=None, VIC_SEX=None, OFNS_DESC="FRAUD",
                   PREM_TYP_DESC="STREET", RPT_DT="x"),
        _complaint(CMPLNT_NUM="c2", CMPLNT_FR_DT="n/a", SUSP_AGE_GROUP="UNKNOWN", SUSP_SEX="U", VIC_SEX="E"),
        _complaint(CMPLNT_NUM="c3", SUSP_AGE_GROUP="-5", SUSP_SEX="M", VIC_SEX="M"),     # bad age
        _complaint(CMPLNT_NUM="c4", SUSP_AGE_GROUP="<18", SUSP_SEX="X", VIC_SEX="M"),    # bad sex
        _complaint(CMPLNT_NUM="c5", SUSP_AGE_GROUP="<18", SUSP_SEX="F", VIC_SEX="Z"),    # bad victim sex
    ]
    a, c = _frames(spark, arrests, complaints)
    out = harmonize(a, c)
    # dropped columns are gone; a raw column neither feed drops (PD_DESC) survives
    assert out.columns == INCIDENT_COLUMNS + ["PD_DESC"]
    rows = {r.CMPLNT_NUM: r for r in out.collect()}
    assert set(rows) == {"a1", "a2", "a3", "c1", "c2"}
    a1, a2, a3, c1, c2 = (rows[k] for k in ["a1", "a2", "a3", "c1", "c2"])
    # union by name: arrest fields land in the right columns, arrest offence survives
    assert (a1.RECORD_TYPE, a1.BORO_NM, a1.SUSP_AGE_GROUP, a1.SUSP_SEX, a1.OFNS_DESC) == \
        ("A", "BROOKLYN", "25-44", "M", "ROBBERY")
    # dates of arrests come from ARREST_DATE; one-digit month/day accepted; junk -> NULL
    assert (a1.Year, a1.Month, str(a1.Date)) == (2019, 1, "2019-01-02")
    assert str(a2.Date) == "2019-01-02"
    assert a3.Date is None and a3.Year is None
    # unknown code and NULL code pass through unchanged
    assert a2.BORO_NM == "X" and a3.BORO_NM is None
    # numeric cast of junk -> NULL, not an error
    assert a1.Latitude == 40.7 and a3.Latitude is None
    # complaints keep NULL age/sex, derive dates from CMPLNT_FR_DT
    assert (c1.RECORD_TYPE, c1.Year, c1.Month, c1.ARREST_DATE) == ("C", 2018, 12, None)
    assert c2.Date is None
    assert a1.CMPLNT_FR_DT is None and a1.PREM_TYP_DESC is None


def test_date_and_hour_parsing(spark):
    df = spark.createDataFrame(
        [("01/02/2019", "07:05:00"), ("1/2/2019", "7:05:00"), ("13/45/2019", "24:00:00"),
         ("junk", "xx"), (None, None), ("02/30/2019", "00:00:00")], "d string, t string")
    got = df.select(civil_date("d").cast("string").alias("d"), clock_hour("t").alias("h")).collect()
    assert [(r.d, r.h) for r in got] == [
        ("2019-01-02", 7), ("2019-01-02", 7), (None, None), (None, None), (None, None), (None, 0)]


def test_union_row_count_is_sum_of_parts(spark, sf_dir):
    from blotter.plans import roles
    from blotter.plans.catalog import incidents
    a = roles.arrests_raw(spark, sf_dir)
    c = roles.complaints_raw(spark, sf_dir)
    inc = incidents(spark, sf_dir)
    n_a = a.filter(F.col("AGE_GROUP").isin(["<18", "18-24", "25-44", "45-64", "65+"])).count()
    assert inc.filter("RECORD_TYPE = 'A'").count() == n_a
    assert inc.count() == n_a + inc.filter("RECORD_TYPE = 'C'").count()
    assert inc.filter("RECORD_TYPE = 'C'").count() <= c.count()


def test_recommended_conf_scales_with_input():
    from blotter.session import recommended_conf
    small = recommended_conf(10 << 30, executors=10, cores_per_executor=4)
    huge = recommended_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 80            # 2 waves of 40 cores
    assert int(huge["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert huge["spark.sql.adaptive.skewJoin.enabled"] == "true"
