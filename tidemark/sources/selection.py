"""What to read: selections on the manifest of missions, logs and outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clean import plain_name
from tidemark.operators.ordered import small

# Variables taken from the near-real-time messages, by group.
MESSAGE_VARIABLES = {
    "/": (
        "depth", "latitude", "longitude", "platform_battery_charge", "platform_battery_voltage",
        "platform_average_current", "time_fix", "latitude_fix", "longitude_fix",
        "downwelling_photosynthetic_photon_flux_in_sea_water",
    ),
    "CTD_Seabird": ("bin_median_sea_water_temperature", "bin_median_sea_water_salinity"),
    "WetLabsBB2FL": (
        "bin_median_mass_concentration_of_chlorophyll_in_sea_water",
        "bin_median_ParticulateBackscatteringCoeff470nm",
        "bin_median_ParticulateBackscatteringCoeff650nm",
    ),
    "_": ("planktivore_HM_AvgRois", "planktivore_LM_AvgRois"),
    "Science": (
        "PeakPlanktivoreLMavgROI", "PeakPlanktivoreLMavgROIDepth", "EdgePlanktivoreLMavgROI",
        "EdgePlanktivoreLMavgROIDepth", "PeakPlanktivoreHMavgROI", "PeakPlanktivoreHMavgROIDepth",
    ),
    "CBIT": ("ampHoursUsed",),
}

# Variables taken from the vehicles' logs, by group.
GROUP_VARIABLES = {
    "/": (
        "longitude", "latitude", "depth", "time", "platform_roll_angle", "platform_pitch_angle",
        "platform_orientation", "platform_speed_wrt_sea_water",
    ),
    "Aanderaa_O2": ("mass_concentration_of_oxygen_in_sea_water",),
    "CTD_NeilBrown": ("sea_water_salinity", "sea_water_temperature"),
    "CTD_Seabird": ("sea_water_salinity", "sea_water_temperature", "mass_concentration_of_oxygen_in_sea_water"),
    "ISUS": ("mole_concentration_of_nitrate_in_sea_water",),
    "PAR_Licor": ("downwelling_photosynthetic_photon_flux_in_sea_water",),
    "WetLabsBB2FL": (
        "mass_concentration_of_chlorophyll_in_sea_water", "OutputChl", "Output470", "Output650",
        "VolumeScatCoeff117deg470nm", "VolumeScatCoeff117deg650nm",
        "ParticulateBackscatteringCoeff470nm", "ParticulateBackscatteringCoeff650nm",
    ),
    "WetLabsSeaOWL_UV_A": (
        "concentration_of_chromophoric_dissolved_organic_matter_in_sea_water",
        "mass_concentration_of_chlorophyll_in_sea_water", "BackscatteringCoeff700nm",
        "VolumeScatCoeff117deg700nm", "mass_concentration_of_petroleum_hydrocarbons_in_sea_water",
    ),
    "_": (
        "planktivore_diatoms", "planktivore_dinoflagellates", "planktivore_caseTemp", "planktivore_caseHumidity",
        "planktivore_casePress", "planktivore_HM_AvgRois", "planktivore_LM_AvgRois",
    ),
    "WetLabsUBAT": (
        "average_bioluminescence", "flow_rate", "digitized_raw_ad_counts", "hv_step_calibration_coefficient",
        "flowrateCalibCoeff",
    ),
    "BPC1": ("platform_battery_charge", "platform_battery_voltage"),
    "BuoyancyServo": ("platform_buoyancy_position",),
    "DeadReckonUsingMultipleVelocitySources": ("fix_residual_percent_distance_traveled", "longitude", "latitude", "depth"),
    "DeadReckonUsingSpeedCalculator": ("fix_residual_percent_distance_traveled", "longitude", "latitude", "depth"),
    "ElevatorServo": ("platform_elevator_angle",),
    "MassServo": ("platform_mass_position",),
    "NAL9602": ("time_fix", "latitude_fix", "longitude_fix"),
    "Onboard": ("platform_average_current",),
    "RudderServo": ("platform_rudder_angle",),
    "ThrusterServo": ("platform_propeller_rotation_rate",),
    "CurrentEstimator": ("current_direction_navigation_frame", "current_speed_navigation_frame"),
}

# Prefixes of single variables in the root group of the messages.
ROOT_PREFIX = {
    "platform_battery_charge": "bpc1",
    "platform_battery_voltage": "bpc1",
    "platform_average_current": "onboard",
    "time_fix": "nal9602",
    "latitude_fix": "nal9602",
    "longitude_fix": "nal9602",
    "downwelling_photosynthetic_photon_flux_in_sea_water": "parlicor",
}


def select_missions(manifest: DataFrame, date: str, years: tuple[int, int], yds: tuple[int, int] | None = None) -> DataFrame:
    """Missions of the years; year-days count only when both years are the same."""
    year = F.year(date)
    chosen = manifest.where(year.between(*years))
    if yds and years[0] == years[1]:
        chosen = chosen.where(F.dayofyear(date).between(*yds))
    return chosen


def directory_time(stamp: Column) -> Column:
    """Time in a directory name; minutes and seconds may be missing."""
    size = F.length(stamp)
    full = F.when(size.isin(11, 13), F.rpad(stamp, 15, "0")).otherwise(stamp)
    return F.when(full.rlike(r"^\d{8}T\d{6}$"), F.to_timestamp(full, "yyyyMMdd'T'HHmmss"))


def select_logs(manifest: DataFrame, directory: str, name: str, start: Column, end: Column, platform: str | None = None) -> DataFrame:
    """Main log files in directories stamped inside ``[start, end]``, optionally of one platform."""
    chosen = manifest.where(F.col(name).rlike(r"^\d{12}_\d{12}\.nc4$"))
    if platform is not None:
        chosen = chosen.where(F.lower("platform") == platform.lower())
    return chosen.withColumn("directory_time", directory_time(F.col(directory))).where(F.col("directory_time").between(start, end))


def last_days(manifest: DataFrame, ts: str, days: int, now: Column | None = None) -> DataFrame:
    """Rows of the last n days before ``now``."""
    now = now if now is not None else F.current_timestamp()
    return manifest.where((F.col(ts) >= now - F.make_dt_interval(F.lit(days))) & (F.col(ts) <= now))


def stale(sources: DataFrame, outputs: DataFrame, on: Sequence[str], clobber: bool = False) -> DataFrame:
    """Sources to process: no output yet, or the source is newer. ``clobber`` takes all."""
    if clobber:
        return sources
    done = outputs.select(*on, F.col("mtime").alias("_out"))
    return sources.join(done, list(on), "left").where(F.col("_out").isNull() | (F.col("mtime") > F.col("_out"))).drop("_out")


def listed_directories(lines: DataFrame, line: str = "line") -> DataFrame:
    """Directories named in deployment lists: no blank lines, no comments."""
    name = F.trim(line)
    return lines.where((name != "") & ~name.startswith("#")).withColumn("directory", name)


def pending(lines: DataFrame, outputs: DataFrame, by: Sequence[str], line: str = "line") -> DataFrame:
    """Listed directories without any output yet."""
    return listed_directories(lines, line).join(outputs.select(*by, "directory"), [*by, "directory"], "left_anti")


def deployment_name(lines: DataFrame, by: Sequence[str], line_no: str = "line_no", line: str = "line") -> DataFrame:
    """Name in the first line of each deployment list, ``# Deployment name: ...``."""
    first = lines.groupBy(*by).agg(F.min_by(line, line_no).alias("_first"))
    name = F.trim(F.regexp_extract(F.trim("_first"), r"(?i)^# deployment name:(.*)$", 1))
    named = F.lower(F.trim("_first")).startswith("# deployment name:")
    return first.select(*by, F.when(named, name).alias("name"))


def output_name(group: Column, var: Column) -> Column:
    """``group_variable`` in lower case; group names lose their underscores."""
    short = F.when(group == "/", "universals").when(group == "_", "backseat").otherwise(F.lower(F.regexp_replace(group, "_", "")))
    named = F.when(F.lower(var) == "platform_orientation", "platform_yaw_angle").otherwise(F.lower(var))
    return F.concat(short, F.lit("_"), named)


def select_groups(df: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Readings of the whitelisted (group, var) pairs with their output name."""
    chosen = df.join(small(whitelist), ["group", "var"], "left_semi")
    return chosen.withColumn("name", output_name(F.col("group"), F.col("var")))


def message_name(group: Column, var: Column) -> Column:
    """Output name of a message variable: coordinates bare, the rest with the prefix of their group."""
    prefixes = F.create_map(*[F.lit(x) for pair in ROOT_PREFIX.items() for x in pair])
    prefix = F.element_at(prefixes, var)
    root = F.when(prefix.isNull(), var).otherwise(F.concat(prefix, F.lit("_"), var))
    short = F.when(group == "_", "backseat").otherwise(F.lower(F.regexp_replace(group, "_", "")))
    return F.when(group == "/", root).otherwise(F.lower(F.concat(short, F.lit("_"), var)))


def whitelist(spark: SparkSession, variables: dict[str, Sequence[str]]) -> DataFrame:
    pairs = [(g, v) for g, names in variables.items() for v in names]
    return spark.createDataFrame(pairs, "group string, var string")


def read_messages(df: DataFrame) -> DataFrame:
    """Whitelisted message readings with output name and bin-free variable name."""
    chosen = df.join(F.broadcast(whitelist(df.sparkSession, MESSAGE_VARIABLES)), ["group", "var"], "left_semi")
    name = message_name(F.col("group"), F.col("var"))
    return chosen.withColumns({"name": name, "plain": plain_name(name)})


def overlapping(deployments: DataFrame, name: str, start: Column, end: Column) -> DataFrame:
    """Deployments whose directory ``yyyyMMdd_yyyyMMdd`` overlaps ``[start, end]``."""
    stamp = r"^(\d{8})_(\d{8})$"
    first = F.to_timestamp(F.nullif(F.regexp_extract(name, stamp, 1), F.lit("")), "yyyyMMdd")
    last = F.to_timestamp(F.nullif(F.regexp_extract(name, stamp, 2), F.lit("")), "yyyyMMdd")
    return deployments.where((first <= end) & (last >= start))


def date_range(mode: str, now: Column, days: int = 0) -> tuple[Column, Column]:
    """Start and end of the current month, the previous month or the last days from midnight."""
    month = F.date_trunc("month", now)
    if mode == "current_month":
        return month, now
    if mode == "previous_month":
        return F.add_months(month, -1).cast("timestamp"), month - F.expr("INTERVAL 1 SECOND")
    if mode == "last_days":
        return F.date_trunc("day", now - F.make_dt_interval(F.lit(days))), now
    raise ValueError(f"unknown mode {mode!r}")

