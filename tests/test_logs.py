"""Log parsers on small logs."""

import struct

import pytest
from pyspark.sql import functions as F

from tidemark.sources import logs, selection, sinks

# The grammar of a log line and the name of the component.
SAMPLER, MOVE, TAKEN = "CANONSampler", "ELMO will go to position", "Sample"


def entry(second, message, level="INFO", component=SAMPLER):
    return f"2024-05-01T06:00:00.000Z,{second:.3f} [{component}]({level}): {message}"


def log(*events):
    """Lines from ``(second, sample number or None for a start)`` and whole lines."""
    return [e if isinstance(e, str) else entry(e[0], MOVE if e[1] is None else f"{TAKEN} {e[1]}, err_code=0", "IMPORTANT" if e[1] else "INFO") for e in events]


@pytest.mark.parametrize(
    "lines, want",
    [
        (log(), {}),
        (log((100, None)), {}),
        (log((100, 1)), {}),
        (log((100, None), (130, 9)), {9: 100.0}),
        (log((100.25, None), (130, 1), (200.5, None), (230, 2), (300.75, None), (330, 3)), {1: 100.25, 2: 200.5, 3: 300.75}),
        # Starts and samples meet in order of number; what is left over has no partner.
        (log((10, None), (20, None), (30, None), (40, 5), (50, 6)), {5: 10.0, 6: 20.0}),
        # A number that comes again has the later start.
        (log((10, None), (15, 4), (20, None), (25, 4)), {4: 20.0}),
        # The informal copy of a message is the one that counts, so it isn't counted twice.
        (log((10, None), entry(15, f"{TAKEN} 7, err_code=0"), (15, 7), (20, None), entry(25, f"{TAKEN} 8, err_code=0"), (25, 8)), {7: 10.0, 8: 20.0}),
        (log("", "free text", entry(5, MOVE, component="Dock"), (10, None), entry(12, f"{TAKEN} 3, err_code=0", component="Dock"), (15, 2)), {2: 10.0}),
    ],
)
def test_cartridge_events(spark, lines, want):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "m int, n long, line string")
    got = {r["sample"]: r["seconds"] for r in logs.cartridge_events(df, ["m"], "n", "line", 2).collect()}
    assert got == pytest.approx(want)


def test_bottle_events(spark):
    text = [
        "x (t = 12.5) -- Behavior FireTheGulper:1 running",
        "y: Gulper::fireGulper - cmd is $031Fff",
        "z: Gulper::fireGulper - cmd is $041Fff",
        "GulperServer - firing gulper 7",
        "x (t = 99.0) Behavior FireTheGulper:-1 has changed to state Finished",
        "Adaptive Sampler has fired gulper 2 at t =   1700000005.0",
        "q: 1700000009 Gulper::fireGulper - cmd is $051Fff",
    ]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(text)], "m int, n long, line string")
    start = spark.createDataFrame([(1, 1000.0)], "m int, t0 double")
    got = {r["bottle"]: r["seconds"] for r in logs.bottle_events(df, start, ["m"], "n", "line", 2).collect()}
    assert got == {3: 1011.5, 7: 1098.0, 2: 1700000004.0, 5: 1700000008.0}


def test_binary_logs(spark, tmp_path):
    header = b"# log\n# timeTag time %f ,Time ,s\n# float depth %f ,Depth ,m\n# short n %d ,Count ,1\n# begin\n"
    records = [(1.5, 2.25, 3), (2.5, -4.5, -7)]
    body = b"".join(struct.pack("<dfh", *r) for r in records)
    (tmp_path / "a.log").write_bytes(header + body + b"\x01\x02\x03")
    (tmp_path / "b.log").write_bytes(header)
    got = logs.read_logs(spark, str(tmp_path)).withColumn("file", F.element_at(F.split("path", "/"), -1)).collect()
    table = {(r["file"], r["seq"], r["var"]): r["value"] for r in got}
    want = {("a.log", i, v): float(x) for i, r in enumerate(records) for v, x in zip(("time", "depth", "n"), r)}
    assert table == want


def test_deployment_lists(spark):
    rows = [("d", 0, "# Deployment name: Bay tour "), ("d", 1, ""), ("d", 2, "# 20230101T000000"), ("d", 3, "20230213T183535"), ("d", 4, "20230214T000000")]
    df = spark.createDataFrame(rows, "dep string, line_no int, line string")
    outputs = spark.createDataFrame([("d", "20230213T183535")], "dep string, directory string")
    assert [r["directory"] for r in selection.pending(df, outputs, ["dep"]).collect()] == ["20230214T000000"]
    assert selection.deployment_name(df, ["dep"]).first()["name"] == "Bay tour"


def test_stage_overwrites_only_its_missions(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1)], "platform string, mission int, v int")
    sinks.write_stage(df, path)
    sinks.write_stage(df.where("platform = 'a' AND mission = 2").withColumn("v", F.lit(9)), path)
    got = sorted((r.platform, r.mission, r.v) for r in sinks.read_stage(spark, path).collect())
    assert got == [("a", 1, 1), ("a", 2, 9), ("b", 1, 1)]


def test_sample_table(spark, tmp_path):
    values = {c: F.lit(v) for c, v in dict(cruise="c1", bottle=4, station=3.7, lat=36.8, lon=-122.0, depth=12.345, temperature=10.0, salinity=33.5, oxygen=4.2).items()}
    empty = {c: F.lit(None).cast("double") for c in ("nitrate", "fluorescence", "bbp420", "bbp700", "par", "bottom_depth")}
    df = spark.range(1).withColumns({**values, **empty, "ts": F.lit("2024-03-01 12:00:00").cast("timestamp")})
    fields = sinks.sample_lines(df).first()["line"].split("\t")
    assert len(fields) == len(sinks.SAMPLE_COLUMNS)
    assert fields[:6] == ["c1", "3", "B", "03/01/2024", "12:00", "238.00000"]
    assert fields[18] == "NaN" and fields[28] == " 61.50000"
    sinks.write_samples(df, str(tmp_path / "odv"))
    assert spark.read.text(str(tmp_path / "odv")).count() == 2
