"""Logs: binary instrument files, positioning text, sampler events, calibration files, tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clean import dedupe_names
from tidemark.operators.ordered import HOUR, Axis, axis, join_back, latest, row_index, scan

# Storage of the log types; every other type is an 8-byte float.
TYPES = {"float": "<f4", "integer": "<i4", "short": "<i2"}

# Line patterns of the bottle sampler's log.
ELAPSED = r".+t =\s+([\d\.]+)\).+Behavior FireTheGulper"
ADAPTIVE = r"Adaptive Sampler has fired gulper (\d+) at t =\s+([\d\.]+)"
TIMED_COMMAND = r": (\d+) Gulper::fireGulper - cmd is \$(\d\d)1Fff"
FINISHED = r"\(t = ([\d\.]+)\) Behavior FireTheGulper:-1 has changed to state Finished"
COMMAND = r": Gulper::fireGulper - cmd is \$(\d\d)1Fff"
SERVER = r"GulperServer - firing gulper (\d+)"

# Line patterns of the cartridge sampler's log.
SYSLOG = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?,(\d+\.\d+)\s\[([^\]]+)\]\(([^\)]+)\):\s(.+)"
SAMPLE = r"Sample (\d+), \(?err_code=(\d+)\)?"
COMPONENT, START = "CANONSampler", "ELMO will go to position"

# Prefixes of the calibration keys that are kept.
COEFFICIENT_PREFIXES = ("t_", "c_", "ep", "SO", "BO", "Vo", "TC", "PC", "Sc", "Da")


def read_logs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Binary logs as rows (path, seq, var, value), any number of files in one job."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return decode_logs(files.select("path", "content"))


def decode_logs(files: DataFrame) -> DataFrame:
    """Typed rows of binary logs: a text header names the fields, fixed-size records follow.

    A short last record is dropped. Every file is decoded on its own, so files spread over tasks.
    """

    def layout(header: bytes) -> np.dtype:
        names, kinds = [], []
        for line in header.decode("iso-8859-15").splitlines()[1:-1]:
            words = line.split(" ")
            names.append(words[2])
            kinds.append(TYPES.get(words[1], "<f8"))
        return np.dtype(list(zip(dedupe_names(names), kinds, strict=True)))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, np.dtype] = {}
        for batch in batches:
            parts, held = [], 0
            for path, content in zip(batch["path"], batch["content"], strict=True):
                start = content.index(b"\n", content.index(b"begin")) + 1
                kind = known.setdefault(content[:start], None) or layout(content[:start])
                known[content[:start]] = kind
                records = np.frombuffer(content, kind, (len(content) - start) // kind.itemsize, start)
                parts += [(path, var, records[var].astype("float64")) for var in kind.names]
                held += len(records) * len(kind.names)
                if held >= 500_000:
                    yield table(parts)
                    parts, held = [], 0
            if parts:
                yield table(parts)

    def table(parts: list[tuple[str, str, np.ndarray]]) -> pd.DataFrame:
        sizes = [len(v) for _, _, v in parts]
        return pd.DataFrame(
            {
                "path": np.repeat(np.array([p for p, _, _ in parts], dtype=object), sizes),
                "seq": np.concatenate([np.arange(n) for n in sizes]),
                "var": np.repeat(np.array([v for _, v, _ in parts], dtype=object), sizes),
                "value": np.concatenate([v for _, _, v in parts]),
            }
        )

    return files.select("path", "content").mapInPandas(decode, "path string, seq long, var string, value double")


def parse_positions(lines: DataFrame, line: str = "line", hours: float = 5.0) -> DataFrame:
    """Acoustic positions from comma-separated text: time moved back by ``hours``, signed degrees."""
    items = F.split(line, ",")

    def degrees(item: Column, negative: str) -> Column:
        words = F.split(item, " ")
        size = F.substring(words[0], 2, 10).cast("double") + words[1].cast("double") / 60.0
        return F.when(F.substring(item, 1, 1) == negative, -size).otherwise(size)

    stamp = F.to_timestamp(F.regexp_extract(items[1], r"^([\d-]+ [\d:]+)", 1), "M-d-yy H:m:s")
    return lines.withColumns(
        {
            "ts": F.timestamp_micros((F.unix_micros(stamp) - F.lit(int(hours * HOUR)))),
            "lat": degrees(items[22], "S"),
            "lon": degrees(items[23], "W"),
        }
    )


def _group(col: str, pattern: str, group: int, kind: str) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit("")).cast(kind)


def bottle_events(lines: DataFrame, missions: DataFrame, by: Sequence[str], line_no: str, line: str, width: float, delay: float = 1.0) -> DataFrame:
    """Bottle numbers and firing times from the sampler's log; ``missions`` has the start ``t0``.

    A line may give the elapsed time or the bottle number for a later one. Both are carried along
    the lines; using the elapsed time clears it. The last time written for a bottle counts.
    """
    by = list(by)
    read = lines.select(
        *by,
        line_no,
        _group(line, ELAPSED, 1, "double").alias("elapsed"),
        _group(line, SERVER, 1, "int").alias("server"),
        _group(line, ADAPTIVE, 1, "int").alias("adaptive"),
        _group(line, ADAPTIVE, 2, "double").alias("adaptive_t"),
        _group(line, TIMED_COMMAND, 2, "int").alias("timed"),
        _group(line, TIMED_COMMAND, 1, "double").alias("timed_t"),
        _group(line, FINISHED, 1, "double").alias("finished"),
        _group(line, COMMAND, 1, "int").alias("command"),
    )
    ax = axis(by, line_no, width)
    is_timed, is_finished = F.col("timed").isNotNull(), F.col("finished").isNotNull()
    is_command = F.col("command").isNotNull() & ~is_timed & ~is_finished
    before = F.coalesce("adaptive", "server")
    named = scan(
        read, ax, _number=latest(F.coalesce(F.when(is_timed, F.col("timed")), F.when(is_command, F.col("command")), before), inclusive=False)
    )
    number = F.coalesce(before, F.col("_number"))
    clears = is_timed | is_command | (is_finished & number.isNotNull())
    mark = F.when(clears, F.lit(-1.0)).otherwise(F.nullif(F.col("elapsed"), F.lit(0.0)))
    timed = join_back(scan(named.withColumn("_mark", mark), ax, _last=latest(F.col("_mark"), inclusive=False)), missions, by)
    known = F.coalesce(F.nullif(F.col("elapsed"), F.lit(0.0)), F.nullif(F.col("_last"), F.lit(-1.0)))
    bottle = F.when(is_timed, F.col("timed")).when(is_finished, number).when(is_command & known.isNotNull(), F.col("command"))
    second = F.when(is_timed, F.col("timed_t")).when(is_finished, F.col("finished") + F.col("t0")).when(is_command, known + F.col("t0"))
    writes = F.array(
        F.struct(F.lit(0).alias("o"), F.col("adaptive").alias("bottle"), F.col("adaptive_t").alias("t")),
        F.struct(F.lit(1).alias("o"), bottle.alias("bottle"), second.alias("t")),
    )
    written = timed.select(*by, line_no, F.explode(writes).alias("w")).where("w.bottle IS NOT NULL")
    return written.groupBy(*by, F.col("w.bottle").alias("bottle")).agg(
        (F.max_by("w.t", F.struct(line_no, "w.o")) - F.lit(delay)).alias("seconds")
    )


def cartridge_events(lines: DataFrame, by: Sequence[str], line_no: str, line: str, width: float) -> DataFrame:
    """Sample numbers and start times: starts and numbers are paired in order of arrival.

    Lines of level INFO are preferred, starts and numbers apart. The shorter list decides how
    many pairs there are; a later pair overwrites the same number.
    """
    by = list(by)
    message = F.col("message")
    read = lines.select(
        *by,
        line_no,
        _group(line, SYSLOG, 1, "double").alias("seconds"),
        F.regexp_extract(line, SYSLOG, 2).alias("component"),
        F.upper(F.regexp_extract(line, SYSLOG, 3)).alias("level"),
        F.regexp_extract(line, SYSLOG, 4).alias("message"),
    ).where(F.col("component") == COMPONENT)
    is_start = message.contains(START)
    sample = F.nullif(F.regexp_extract(message, SAMPLE, 1), F.lit("")).cast("int")
    usable = is_start | (sample.isNotNull() & F.col("level").isin("INFO", "IMPORTANT"))
    events = read.where(usable).select(
        *by, line_no, "seconds", F.when(is_start, "start").otherwise("number").alias("kind"), sample.alias("sample"),
        (F.col("level") != "INFO").cast("int").alias("rank"),
    )
    best = events.groupBy(*by, "kind").agg(F.min("rank").alias("rank"))
    chosen = join_back(events, best, [*by, "kind", "rank"], "left_semi")
    ordered = row_index(chosen, Axis((*by, "kind"), (line_no,), width), "nth")
    starts = ordered.where("kind = 'start'").select(*by, "nth", "seconds")
    numbers = ordered.where("kind = 'number'").select(*by, "nth", "sample")
    return join_back(starts, numbers, [*by, "nth"]).groupBy(*by, "sample").agg(F.max_by("seconds", "nth").alias("seconds"))


def read_coefficients(lines: DataFrame, by: Sequence[str], line_no: str, line: str = "line") -> DataFrame:
    """Coefficients of text calibrations: comments skipped, known prefixes kept, last value wins.

    ``t_coefs`` and ``c_coefs`` name the coefficient set, ``A`` where the file has none.
    """
    key = F.trim(F.element_at(F.split(line, "="), 1))
    value = F.trim(F.element_at(F.split(F.element_at(F.split(line, "="), 2), ";"), 1))
    kept = lines.where(~F.col(line).startswith("//") & F.substring(line, 1, 2).isin(*COEFFICIENT_PREFIXES) & F.col(line).contains("="))
    named = kept.select(*by, line_no, key.alias("name"), value.alias("text"))
    defaults = lines.select(*by).distinct().withColumn("name", F.explode(F.array(F.lit("t_coefs"), F.lit("c_coefs"))))
    rows = named.unionByName(defaults.withColumns({line_no: F.lit(-1).cast("bigint"), "text": F.lit("A")}))
    is_set = F.col("name").isin("t_coefs", "c_coefs")
    number = F.col("text").try_cast("double")
    usable = rows.where(is_set | number.isNotNull())
    return usable.groupBy(*by, "name").agg(F.max_by("text", line_no).alias("text")).withColumn("value", F.when(~is_set, number))


def read_sections(lines: DataFrame, by: Sequence[str], line_no: str, width: float, line: str = "line") -> DataFrame:
    """Key-value calibrations with ``[General]`` and ``[Channel n]`` sections.

    The attenuation exponent gets its default in the first two channels when neither has one.
    """
    by = list(by)
    channel = F.regexp_extract(line, r"\[Channel\s*(\d+)\s*\]", 1)
    head = F.when(F.col(line).contains("[General]"), "General").when(channel != "", F.concat(F.lit("Ch"), channel.cast("int").cast("string")))
    inside = scan(lines.withColumn("_head", head), axis(by, line_no, width), section=latest(F.col("_head")))
    pairs = inside.where(F.col("_head").isNull() & F.col(line).contains("=")).select(
        *by, line_no, "section", F.trim(F.element_at(F.split(line, "="), 1)).alias("name"), F.trim(F.element_at(F.split(line, "="), 2)).alias("text")
    )
    values = pairs.groupBy(*by, "section", "name").agg(F.max_by("text", line_no).alias("text"))
    has = F.coalesce(F.bool_or((F.col("name") == "SigmaExp") & F.col("section").isin("Ch1", "Ch2")), F.lit(False))
    serial = F.max(F.when((F.col("section") == "General") & (F.col("name") == "Serial"), F.col("text")))
    lacking = values.groupBy(*by).agg(has.alias("_has"), serial.alias("_serial")).where("NOT _has")
    # Exponents of one instrument by serial number, and the mean of all others.
    own = F.col("_serial") == "H2000325"
    filled = lacking.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.lit("Ch1").alias("section"), F.when(own, "0.1460").otherwise("0.1486").alias("text")),
                F.struct(F.lit("Ch2").alias("section"), F.when(own, "0.1600").otherwise("0.1522").alias("text")),
            )
        ).alias("_d"),
    ).select(*by, "_d.section", F.lit("SigmaExp").alias("name"), "_d.text")
    return values.unionByName(filled)


def read_xml_coefficients(files: DataFrame, by: Sequence[str], xml: str, names: Sequence[str]) -> DataFrame:
    """Coefficients of equation 1 in XML calibrations, one column per name, and the serial number."""
    found = [
        F.xpath_string(F.col(xml), F.lit(f"//CalibrationCoefficients[@equation='1']/{n}/text()")).try_cast("double").alias(n) for n in names
    ]
    return files.select(*by, F.xpath_string(F.col(xml), F.lit("//SerialNumber/text()")).alias("serial"), *found)


def read_measurements(
    spark: SparkSession, path: str, columns: Sequence[str], limits: dict[str, tuple], equal: dict[str, Sequence] | None = None
) -> DataFrame:
    """Measurement table with column pruning and range and membership filters pushed to the scan."""
    df = spark.read.parquet(path)
    for col, (lo, hi) in limits.items():
        df = df.where((F.col(col) >= F.lit(lo)) & (F.col(col) <= F.lit(hi)))
    for col, values in (equal or {}).items():
        df = df.where(F.col(col).isin(*values))
    return df.select(*columns)
