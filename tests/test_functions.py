import datetime as dt

import pytest
from pyspark.sql import functions as F

from wearline.config import HorizonBands
from wearline.functions import dates, numbers, ratings, text

D = dt.date


def test_inspection_dates(rows):
    data = [("3211991",), ("12281994",), ("10211991",), ("2024-10-21",), ("2022-11-22",), ("",),
            (None,), ("junk",), ("10/21/2024",), ("2024",), ("13991991",), ("3211991.0",),
            ("2024-10-21 08:30:00",), ("1/5/2020",)]
    found = [r[0] for r in rows(data, "d string", dates.inspection_date(F.col("d")))]
    assert found == [D(1991, 3, 21), D(1994, 12, 28), D(1991, 10, 21), D(2024, 10, 21),
                     D(2022, 11, 22), None, None, None, D(2024, 10, 21), None, None, D(1991, 3, 21),
                     D(2024, 10, 21), D(2020, 1, 5)]


def test_native_dates_and_packed_integers(rows):
    assert rows([(D(2024, 10, 21),)], "d date", dates.inspection_date(F.col("d"))) == [(D(2024, 10, 21),)]
    assert rows([(3211991,)], "d int", dates.inspection_date(F.col("d"))) == [(D(1991, 3, 21),)]


def test_age_is_clipped_and_keeps_null(rows):
    data = [(D(2010, 5, 15), 1990.0), (D(2010, 5, 15), 110.0), (D(2010, 5, 15), 9650.0),
            (D(2010, 5, 15), None)]
    ages = rows(data, "d date, y double", dates.age_on(F.col("d"), F.col("y")))
    assert [a for a, in ages] == [20.0, 130.0, 0.0, None]


def test_packed_degrees(rows):
    data = [(29153429.0, 95210096.0), (291534.0, 952100.0), (29.2595, -95.35), (0.0, 0.0),
            (None, None), (12345678.0, 999.0), (31.32, -97.17)]
    found = rows(data, "lat double, lon double",
                 numbers.within(numbers.decode_degrees(F.col("lat")), 24, 38),
                 numbers.within(numbers.decode_degrees(F.col("lon"), west=True), -108, -92))
    lat, lon = zip(*found)
    assert lat[0] == pytest.approx(29.2595, abs=1e-4) and lon[0] == pytest.approx(-95.3503, abs=1e-4)
    assert lat[1] == pytest.approx(lat[0], abs=1e-3) and lon[1] == pytest.approx(-95.35)
    assert lat[2] == 29.2595 and lon[2] == -95.35
    assert lat[3:6] == (None, None, None) and lon[3:6] == (None, None, None)
    assert lat[6] == 31.32 and lon[6] == -97.17


def test_hundredths_and_numbers(rows):
    data = [("227",), ("1.21",), ("N",), (None,), ("NaN",), (" 5000 ",), ("-3",)]
    found = rows(data, "v string", numbers.to_number(F.col("v")),
                 numbers.decode_hundredths(numbers.to_number(F.col("v"))))
    assert [a for a, _ in found] == [227.0, 1.21, None, None, None, 5000.0, -3.0]
    assert [b for _, b in found][:2] == [2.27, 1.21]


def test_half_even_and_ratio(rows):
    found = rows([(0.5, 0.0), (1.5, 2.0), (2.5, 5.0)], "a double, b double",
                 numbers.half_even(F.col("a")), numbers.ratio(F.col("a"), F.col("b")))
    assert found == [(0.0, None), (2.0, 0.75), (2.0, 0.5)]


def test_codes_and_ids(rows):
    data = [("01",), ("1",), (" 03 ",), ("12",), ("00",), ("A1",), (None,)]
    assert [r[0] for r in rows(data, "c string", text.bare_code(F.col("c")))] == \
        ["1", "1", "3", "12", "0", "A1", None]
    data = [(" 001 ",), ("nan",), ("None",), ("",), (None,)]
    assert [r[0] for r in rows(data, "c string", text.clean_id(F.col("c")))] == \
        ["001", None, None, None, None]
    assert rows([("El Paso/1",)], "c string", text.file_safe(F.col("c"))) == [("El_Paso_1",)]


def test_on_system(rows):
    data = [("ON",), (" on ",), ("OFF",), ("ONLY",), (None,)]
    found = rows(data, "s string", text.is_on_system(F.col("s")), text.is_on_system(F.col("s"), True))
    assert found == [(True, True), (True, True), (False, False), (False, True), (None, None)]


def test_horizon_labels_are_right_closed(rows):
    data = [(0.0,), (0.1,), (3.5,), (3.6,), (7.5,), (12.5,), (25.0,), (25.1,)]
    found = rows(data, "h double", ratings.horizon_label(F.col("h"), HorizonBands()))
    assert [r[0] for r in found] == [None, "~2y", "~2y", "~5y", "~5y", "~10y", "~20y", None]


def test_bands_routes_and_flags(rows):
    assert [r[0] for r in rows([(7.0,), (5.0,), (4.9,), (None,)], "r double",
                               ratings.rating_band(F.col("r")))] == ["good", "fair", "poor", "not rated"]
    assert [r[0] for r in rows([(0.0,), (3.0,), (5.0,), (7.0,)], "h double",
                               ratings.forecast_route(F.col("h"), 3.0))] == \
        ["observed", "carry", "model", "interpolated"]
    assert [r[0] for r in rows([(-1.0,), (-0.2,), (0.0,)], "c double",
                               ratings.decline_flag(F.col("c")))] == ["severe", "mild", "none"]
    assert [r[0] for r in rows([(50.0,), (30.0,), (None,)], "c double",
                               ratings.risk_flag(F.col("c")))] == ["high", "raised", "none"]


def test_interpolation_between_anchors(rows):
    values = {0: 7.0, 2: 7.0, 5: 6.0, 10: 5.0, 15: None, 20: 4.0}
    data = [(values, h) for h in (0.0, 5.0, 6.0, 7.5, 12.0, 15.0, 18.0)]
    found = rows(data, "m map<int,double>, h double", ratings.at_horizon(F.col("m"), F.col("h")))
    assert [r[0] for r in found] == [7.0, 6.0, 5.8, 5.5, 5.0, None, 4.0]


def test_quantile_of_a_distribution(rows):
    spread = [0.0] * 4 + [0.25, 0.25, 0.5, 0.0, 0.0, 0.0]
    point = [0.0] * 9 + [1.0]
    found = rows([(spread,), (point,)], "p array<double>", ratings.quantile_of(F.col("p"), 0.25),
                 ratings.quantile_of(F.col("p"), 0.5), ratings.mean_of(F.col("p")),
                 ratings.mass_at_or_below(F.col("p"), 5.0))
    assert found[0] == pytest.approx((4.5, 5.5, 5.25, 0.5))
    assert found[1] == pytest.approx((8.75, 9.0, 9.0, 0.0))
