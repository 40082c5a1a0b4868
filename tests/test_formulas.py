"""Published check values of the formulas."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import biology, geo, optics
from tidemark.functions import seawater as sw
from tidemark.operators.clean import dedupe_names


@pytest.fixture(scope="module")
def value(spark):
    one = spark.range(1)
    return lambda col: one.select(col.alias("v")).first()[0]


def t68(t):
    return F.lit(t / 1.00024)


@pytest.mark.parametrize("r,t,p,s", [(1.0, 15.0, 0.0, 35.0), (1.2, 20.0, 2000.0, 37.245628), (0.65, 5.0, 1500.0, 27.995347)])
def test_salinity(value, r, t, p, s):
    assert value(sw.salinity(F.lit(r), t68(t), F.lit(p))) == pytest.approx(s, abs=2e-6)


@pytest.mark.parametrize("s,t,p,rho", [(0.0, 5.0, 0.0, 999.96675), (35.0, 5.0, 0.0, 1027.67547), (35.0, 25.0, 10000.0, 1062.53817)])
def test_density(value, s, t, p, rho):
    assert value(sw.density(F.lit(s), t68(t), F.lit(p))) == pytest.approx(rho, abs=1e-5)


def test_sound_speed_and_pressure(value):
    assert value(sw.sound_speed(F.lit(40.0), t68(40.0), F.lit(10000.0))) == pytest.approx(1731.995, abs=1e-3)
    assert value(sw.pressure(F.lit(7321.45), 30.0)) == pytest.approx(7500.00, abs=0.01)


@pytest.mark.parametrize("pitch", range(0, 361, 45))
def test_offset_along_the_axis_is_the_sine(value, pitch):
    assert value(geo.vertical_offset(1.0, 0.0, F.lit(float(pitch)))) == pytest.approx(math.sin(math.radians(pitch)), abs=1e-15)


@pytest.mark.parametrize(
    "x,y,pitch,height",
    [(0.7071, 0.7071, 0.0, 0.7071), (0.7071, 0.7071, 45.0, 1.0)]
    + [(0.1397, -0.2794, math.degrees(p), h) for p, h in ((0.2928, -0.2272), (0.2939, -0.2270), (0.2952, -0.2267))],
)
def test_offset(value, x, y, pitch, height):
    assert value(geo.vertical_offset(x, y, F.lit(pitch))) == pytest.approx(height, abs=1e-4)


def test_utm_round_trip(value, spark):
    zone = F.lit(10)
    # Reference point: 36.8 N, 122.0 W is 1.0 degree east of the central meridian of zone 10.
    east, north = geo.utm_forward(F.lit(36.8), F.lit(-122.0), zone)
    e, n = value(east), value(north)
    assert 588_000 < e < 590_000 and 4_072_000 < n < 4_074_000
    lat, lon = geo.utm_inverse(F.lit(e), F.lit(n), zone)
    assert value(lat) == pytest.approx(36.8, abs=1e-9) and value(lon) == pytest.approx(-122.0, abs=1e-9)
    assert value(geo.utm_zone(F.lit(-122.0))) == 10


def test_sun(value):
    noon = 1_718_913_600_000_000 - 2 * 3600 * 1_000_000 + 2 * 3600 * 1_000_000
    high = value(geo.sun_altitude(F.lit(36.8), F.lit(-122.0), F.lit(noon)))
    low = value(geo.sun_altitude(F.lit(36.8), F.lit(-122.0), F.lit(noon + 12 * 3600 * 1_000_000)))
    assert 76 < high < 77 and low < -25


def test_optics(value):
    assert value(optics.transmittance(F.lit(4.701))) == pytest.approx(1)
    assert value(optics.attenuation(F.lit(-0.1))) is None
    assert value(optics.signed16(F.lit(65535))) == -1
    assert value(optics.gain(F.lit(3), (1.0, 2.0, 7.0, 4.0, 5.0))) == 7.0
    assert value(optics.gain(F.lit(0), (1.0, 2.0, 7.0, 4.0, 5.0))) == 0.0


def test_proxies_keep_missing_values(value):
    parts = biology.proxies(F.lit(None).cast("double"), F.lit(1e12), 3.9811e13, 0.0047)
    assert all(value(parts[k]) is None for k in ("adinos", "hdinos", "diatoms"))
    assert value(biology.flow_speed(F.lit(50.0), F.lit(10.0))) is None


def test_size_bin_tie_is_smaller(value):
    assert value(biology.size_bin(F.lit(115.5))) == 0
    assert value(biology.size_bin(F.lit(115.6))) == 1
    assert value(biology.size_bin(F.lit(1e9))) == 993


def test_dedupe_names():
    assert dedupe_names(["a", "t", "t", "b", "t"]) == ["a", "t", "t2", "b", "t3"]
    with pytest.raises(ValueError):
        dedupe_names(["a", "a", "b", "b"])
