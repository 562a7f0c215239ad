"""Retail (store / catalog / web) tables derived from the driver's tables.

The workload is a retail decision-support suite over 24 tables (7 facts,
17 dimensions).  The test data holds an order-entry schema instead
(``lineitem orders customer part supplier``), so the retail tables are
*derived* from it:

* one item per part, one customer per customer and two addresses each, so
  the dimensions grow with the input and hold its attributes;
* one sale line per (order, item): ``lineitem`` joined to ``orders`` and
  grouped; ``order % 3`` picks the channel (store, catalog, web);
* sales lean to favourites: three lines in four are sold as the first item
  of their group of eleven neighbours, and four orders in five are placed by
  the first customer of theirs, so that customers meet the same items again
  in other channels;
* returns are the sale lines whose return flag is ``R``;
* the calendar spans the years of the orders and of what follows them;
* the time of day and the small outlet dimensions come from number ranges.

Every column is one SQL expression in ``_specs``; Spark evaluates it with
``selectExpr`` and the DuckDB oracle evaluates the very same text as a
``WITH`` prelude (``duckdb_prelude``), so both engines see equal tables.
Only ``+ - * %``, CASE, CAST and exact decimals are used.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.tables import DIST_KEY, PART_KEY, Ranges, attach_bucketed, read_ranges, save_bucketed, write_range_partitioned
from .dialect import DUCK, SPARK, Dialect, sql_type

# ---------------------------------------------------------------------------
# Fixed values (names used for dimension attributes; chosen for this repo).
# ---------------------------------------------------------------------------
CATEGORIES = ["Books", "Children", "Electronics", "Home", "Jewelry",
              "Men", "Music", "Shoes", "Sports", "Women"]
CLASSES = ["accessories", "athletic", "baseball", "birdwatching", "classical",
           "computers", "country", "dresses", "fiction", "football",
           "fragrances", "history", "infants", "kids", "mens",
           "pants", "personal", "portable", "reference", "rock",
           "self-help", "shirts", "stereo", "swimwear", "womens"]
COLORS = ["aquamarine", "blanched", "burlywood", "burnished", "chiffon", "floral",
          "indian", "medium", "pale", "purple", "slate", "spring"]
UNITS = ["Box", "Bunch", "Case", "Dozen", "Each", "Gross", "Lb", "Oz"]
SIZES = ["petite", "small", "medium", "large", "extra large", "N/A"]
STATES = ["TN", "GA", "TX", "OH", "KY", "VA", "CA", "WA", "IL", "NM"]
COUNTIES = ["Williamson County", "Walker County", "Ziebach County", "Fairfield County",
            "Richland County", "Franklin Parish", "Bronx County", "Barrow County",
            "Daviess County", "Luce County", "Huron County", "Kittitas County",
            "Orange County", "Jackson County", "Mobile County"]
CITIES = ["Midway", "Fairview", "Oak Grove", "Five Points", "Centerville", "Liberty",
          "Pleasant Hill", "Riverside", "Union", "Greenwood", "Oakland", "Salem"]
STREET_NAMES = ["Main", "Oak", "Park", "Elm", "Lake", "Hill", "Cedar", "Maple"]
STREET_TYPES = ["Street", "Avenue", "Boulevard", "Road", "Lane"]
STORE_NAMES = ["ese", "ought", "able", "bar"]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
GENDERS = ["M", "F"]
MARITAL = ["M", "S", "D", "W", "U"]
EDUCATION = ["Primary", "Secondary", "College", "2 yr Degree", "4 yr Degree",
             "Advanced Degree", "Unknown"]
CREDIT = ["Good", "High Risk", "Low Risk", "Unknown"]
BUY_POTENTIAL = [">10000", "5001-10000", "1001-5000", "501-1000", "0-500", "Unknown"]
PROMO_NAMES = ["ought", "able", "pri", "ese", "anti", "cally", "ation", "eing", "bar", "n st"]
REASONS = ["Package was damaged", "Stopped working", "Did not get it on time",
           "Not the product that was ordered", "Parts missing", "Does not work with a product that I have",
           "Gift exchange", "Did not like the color", "Did not like the model", "Found a better price"]
SHIP_TYPES = ["EXPRESS", "NEXT DAY", "OVERNIGHT", "REGULAR", "TWO DAY", "LIBRARY"]
SHIP_CODES = ["AIR", "SURFACE", "SEA"]
CARRIERS = ["UPS", "FEDEX", "AIRBORNE", "USPS", "DHL", "TBS", "ZHOU", "ZOUROS", "MSC", "LATVIAN",
            "ALLIANCE", "ORIENTAL", "BARIAN", "BOXBUNDLES", "GREAT EASTERN", "DIAMOND",
            "RUPEKSA", "GERMA", "HARMSTORF", "PRIVATECARRIER"]
WAREHOUSES = ["Conventional childr", "Important issues liv", "Doors canno", "Bad cards must make.",
              "Operations within"]
CALL_CENTERS = ["NY Metro", "Mid Atlantic", "North Midwest", "California"]
SITE_COMPANIES = ["pri", "able", "ought", "ese", "anti", "cally"]
COUNTRIES = ["UNITED STATES", "CANADA", "M\u00c9XICO", "GERMANY"]

# Day numbers: 2450815 is 1998-01-01.  Ship and return dates follow their sale
# by up to AFTER_DAYS.
DATE_SK_1998, AFTER_DAYS = 2450815, 180
# Neighbouring parts (customers) whose sales lean to the first of them; prime,
# so that the first ones still spread over all attribute values.
NEIGHBOURS = 11


@dataclass(frozen=True)
class Sizes:
    """Scalars that the derivation takes from the input: the number of
    customers, the first and last day of the calendar, the number of parts."""
    customers: int
    first_day: int
    last_day: int
    parts: int = 0


def _case(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


@dataclass
class Spec:
    source: str                      # base relation key
    stages: list[list[tuple[str, str]]] = field(default_factory=list)
    cols: list[tuple[str, str, str]] = field(default_factory=list)  # (name, expr, type)


def _addr_cols(d: Dialect, p: str, k: str) -> list[tuple[str, str, str]]:
    """Address attributes of key ``k`` for a table with column prefix ``p``."""
    return [
        (f"{p}street_number", f"CAST({k} % 1000 + 1 AS STRING)", "s"),
        (f"{p}street_name", _case(f"{k} % 8", STREET_NAMES), "s"),
        (f"{p}street_type", _case(f"{k} % 5", STREET_TYPES), "s"),
        (f"{p}suite_number", f"concat('Suite ', CAST({k} % 100 AS STRING))", "s"),
        (f"{p}city", _case(f"{k} % 12", CITIES), "s"),
        (f"{p}county", _case(f"{k} % 15", COUNTIES), "s"),
        (f"{p}state", _case(f"{k} % 10", STATES), "s"),
        (f"{p}zip", f"CAST(10000 + ({k} % 60) * 311 AS STRING)", "s"),
        (f"{p}country", "'United States'", "s"),
        (f"{p}gmt_offset", f"-5 - {k} % 4", "d5.2"),
    ]


def _id(prefix: str, k: str = "k") -> str:
    return f"concat('{prefix}', lpad(CAST({k} AS STRING), 15, '0'))"


def _specs(d: Dialect, nc: str = "0", lo: str = "0", hi: str = "0") -> dict[str, Spec]:
    """All 24 tables.  ``nc``, ``lo`` and ``hi`` are SQL texts for the number
    of customers and the first and last day number of the calendar."""
    s: dict[str, Spec] = {}

    s["date_dim"] = Spec(
        "days",
        [[("dt", d.date_plus("DATE '1998-01-01'", f"k - {DATE_SK_1998}"))],
         [("y", "year(dt)"), ("m", "month(dt)"), ("dom", "dayofmonth(dt)"),
          ("qoy", "quarter(dt)"), ("dow", "(k + 1) % 7"),
          ("ld", d.days_between("last_day(dt)", "dt"))]],
        [("d_date_sk", "k", "i"), ("d_date_id", _id("D"), "s"), ("d_date", "dt", "date"),
         ("d_month_seq", "(y - 1900) * 12 + m - 1", "i"),
         ("d_week_seq", f"{d.div('k + 1', '7')} - 345000", "i"),
         ("d_quarter_seq", "(y - 1900) * 4 + qoy - 1", "i"),
         ("d_year", "y", "i"), ("d_dow", "dow", "i"), ("d_moy", "m", "i"), ("d_dom", "dom", "i"),
         ("d_qoy", "qoy", "i"), ("d_fy_year", "y", "i"),
         ("d_fy_quarter_seq", "(y - 1900) * 4 + qoy - 1", "i"),
         ("d_fy_week_seq", f"{d.div('k + 1', '7')} - 345000", "i"),
         ("d_day_name", _case("dow", DAY_NAMES), "s"),
         ("d_quarter_name", "concat(CAST(y AS STRING), 'Q', CAST(qoy AS STRING))", "s"),
         ("d_holiday", "CASE WHEN (m = 12 AND dom = 25) OR (m = 1 AND dom = 1) OR (m = 7 AND dom = 4) "
                       "THEN 'Y' ELSE 'N' END", "s"),
         ("d_weekend", "CASE WHEN dow IN (0, 6) THEN 'Y' ELSE 'N' END", "s"),
         ("d_following_holiday", "CASE WHEN (m = 12 AND dom = 26) OR (m = 1 AND dom = 2) "
                                 "OR (m = 7 AND dom = 5) THEN 'Y' ELSE 'N' END", "s"),
         ("d_first_dom", "k - dom + 1", "i"), ("d_last_dom", "k + ld", "i"),
         ("d_same_day_ly", "k - 365", "i"), ("d_same_day_lq", "k - 91", "i"),
         ("d_current_day", "'N'", "s"), ("d_current_week", "'N'", "s"),
         ("d_current_month", "'N'", "s"), ("d_current_quarter", "'N'", "s"),
         ("d_current_year", "'N'", "s")])

    hr = d.div("k", "3600")
    s["time_dim"] = Spec(
        "range:0:86400", [[("hr", hr)]],
        [("t_time_sk", "k", "i"), ("t_time_id", _id("T"), "s"), ("t_time", "k", "i"),
         ("t_hour", "hr", "i"), ("t_minute", f"{d.div('k', '60')} % 60", "i"),
         ("t_second", "k % 60", "i"),
         ("t_am_pm", "CASE WHEN hr < 12 THEN 'AM' ELSE 'PM' END", "s"),
         ("t_shift", "CASE WHEN hr < 8 THEN 'third' WHEN hr < 16 THEN 'first' ELSE 'second' END", "s"),
         ("t_sub_shift", "CASE WHEN hr < 6 THEN 'night' WHEN hr < 12 THEN 'morning' "
                         "WHEN hr < 18 THEN 'afternoon' ELSE 'evening' END", "s"),
         ("t_meal_time", "CASE WHEN hr BETWEEN 6 AND 8 THEN 'breakfast' WHEN hr BETWEEN 11 AND 13 "
                         "THEN 'lunch' WHEN hr BETWEEN 17 AND 20 THEN 'dinner' END", "s")])

    price = "CAST((100 + (k * 97) % 19900) * 0.01 AS DECIMAL(7,2))"
    s["item"] = Spec(
        "part", [[("cp", price), ("mf", "k % 50 + 1")]],
        [("i_item_sk", "k", "i"), ("i_item_id", _id("I"), "s"),
         ("i_rec_start_date", "DATE '1997-10-27'", "date"),
         ("i_rec_end_date", "CAST(NULL AS DATE)", "date"),
         ("i_item_desc", "concat(pn, ' of type ', pt)", "s"),
         ("i_current_price", "cp", "d7.2"),
         ("i_wholesale_cost", "CAST(cp * 0.60 AS DECIMAL(7,2))", "d7.2"),
         ("i_brand_id", "CAST(substr(pb, 7) AS INT)", "i"), ("i_brand", "pb", "s"),
         ("i_class_id", "k % 25 + 1", "i"), ("i_class", _case("k % 25", CLASSES), "s"),
         ("i_category_id", "k % 10 + 1", "i"), ("i_category", _case("k % 10", CATEGORIES), "s"),
         ("i_manufact_id", "mf", "i"), ("i_manufact", "concat('manufact#', CAST(mf AS STRING))", "s"),
         ("i_size", _case("k % 6", SIZES), "s"),
         ("i_formulation", "concat('formula', CAST(k % 9 AS STRING))", "s"),
         ("i_color", _case("k % 12", COLORS), "s"), ("i_units", _case("k % 8", UNITS), "s"),
         ("i_container", "'Unknown'", "s"), ("i_manager_id", "k % 20 + 1", "i"),
         ("i_product_name", "concat(pn, '#', CAST(k AS STRING))", "s")])

    s["customer"] = Spec(
        "customer", [],
        [("c_customer_sk", "k", "i"), ("c_customer_id", _id("C"), "s"),
         ("c_current_cdemo_sk", "k * 5 % 1400", "i"), ("c_current_hdemo_sk", "k * 37 % 720", "i"),
         ("c_current_addr_sk", "2 * k + k % 3 % 2", "i"),
         ("c_first_shipto_date_sk", f"{lo} + (k * 37) % 2000", "i"),
         ("c_first_sales_date_sk", f"{lo} + (k * 37) % 2000 + 30", "i"),
         ("c_salutation", _case("k % 4", ["Mr.", "Mrs.", "Ms.", "Dr."]), "s"),
         ("c_first_name", "concat('F', CAST(k % 8 AS STRING))", "s"),
         ("c_last_name", "concat('L', CAST(k % 20 AS STRING))", "s"),
         ("c_preferred_cust_flag", "CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END", "s"),
         ("c_birth_day", "k % 28 + 1", "i"), ("c_birth_month", "k % 12 + 1", "i"),
         ("c_birth_year", "1930 + k % 60", "i"),
         ("c_birth_country", _case("k % 4", COUNTRIES), "s"),
         ("c_login", "cn", "s"),
         ("c_email_address", "concat('cust', CAST(k AS STRING), '@example.com')", "s"),
         ("c_last_review_date", f"CAST({lo} + 2000 + k % 600 AS STRING)", "s")])

    s["customer_address"] = Spec(
        "addr", [],
        [("ca_address_sk", "k", "i"), ("ca_address_id", _id("A"), "s")]
        + _addr_cols(d, "ca_", "k")
        + [("ca_location_type", _case("k % 3", ["apartment", "condo", "single family"]), "s")])

    s["customer_demographics"] = Spec(
        "range:0:1400", [],
        [("cd_demo_sk", "k", "i"), ("cd_gender", _case("k % 2", GENDERS), "s"),
         ("cd_marital_status", _case(f"{d.div('k', '2')} % 5", MARITAL), "s"),
         ("cd_education_status", _case(f"{d.div('k', '10')} % 7", EDUCATION), "s"),
         ("cd_purchase_estimate", f"({d.div('k', '70')} % 20 + 1) * 500", "i"),
         ("cd_credit_rating", _case(f"{d.div('k', '7')} % 4", CREDIT), "s"),
         ("cd_dep_count", "k % 7", "i"), ("cd_dep_employed_count", f"{d.div('k', '3')} % 7", "i"),
         ("cd_dep_college_count", f"{d.div('k', '5')} % 7", "i")])

    s["household_demographics"] = Spec(
        "range:0:720", [],
        [("hd_demo_sk", "k", "i"), ("hd_income_band_sk", "k % 20 + 1", "i"),
         ("hd_buy_potential", _case(f"{d.div('k', '20')} % 6", BUY_POTENTIAL), "s"),
         ("hd_dep_count", "(k * 7) % 10", "i"), ("hd_vehicle_count", f"{d.div('k', '120')} % 6 - 1", "i")])

    s["income_band"] = Spec(
        "range:1:21", [],
        [("ib_income_band_sk", "k", "i"),
         ("ib_lower_bound", "CASE WHEN k = 1 THEN 0 ELSE (k - 1) * 10000 + 1 END", "i"),
         ("ib_upper_bound", "k * 10000", "i")])

    s["store"] = Spec(
        "range:1:13", [],
        [("s_store_sk", "k", "i"), ("s_store_id", _id("S"), "s"),
         ("s_rec_start_date", "DATE '1997-03-13'", "date"),
         ("s_rec_end_date", "CAST(NULL AS DATE)", "date"),
         ("s_closed_date_sk", "CAST(NULL AS INT)", "i"),
         ("s_store_name", _case("k % 4", STORE_NAMES), "s"),
         ("s_number_employees", "200 + 8 * k", "i"), ("s_floor_space", "5000000 + k * 1000", "i"),
         ("s_hours", _case("k % 3", ["8AM-4PM", "8AM-8PM", "8AM-12AM"]), "s"),
         ("s_manager", "concat('Manager ', CAST(k AS STRING))", "s"),
         ("s_market_id", "k % 4 + 5", "i"), ("s_geography_class", "'Unknown'", "s"),
         ("s_market_desc", "concat('Market ', CAST(k % 4 + 5 AS STRING))", "s"),
         ("s_market_manager", "concat('Market manager ', CAST(k % 4 AS STRING))", "s"),
         ("s_division_id", "1", "i"), ("s_division_name", "'Unknown'", "s"),
         ("s_company_id", "1", "i"), ("s_company_name", "'Unknown'", "s")]
        + [(n, e, t) for n, e, t in _addr_cols(d, "s_", "k")]
        + [("s_tax_precentage", "0.03", "d5.2")])

    s["promotion"] = Spec(
        "range:1:31", [],
        [("p_promo_sk", "k", "i"), ("p_promo_id", _id("P"), "s"),
         ("p_start_date_sk", f"{DATE_SK_1998} + k * 30", "i"),
         ("p_end_date_sk", f"{DATE_SK_1998} + k * 30 + 60", "i"),
         ("p_item_sk", "k", "i"), ("p_cost", "1000", "d15.2"), ("p_response_target", "1", "i"),
         ("p_promo_name", _case("k % 10", PROMO_NAMES), "s"),
         ("p_channel_dmail", "CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END", "s"),
         ("p_channel_email", "CASE WHEN k % 3 = 0 THEN 'Y' ELSE 'N' END", "s"),
         ("p_channel_catalog", "CASE WHEN k % 7 = 0 THEN 'Y' ELSE 'N' END", "s"),
         ("p_channel_tv", "CASE WHEN k % 4 = 0 THEN 'Y' ELSE 'N' END", "s"),
         ("p_channel_radio", "'N'", "s"), ("p_channel_press", "'N'", "s"),
         ("p_channel_event", "CASE WHEN k % 5 = 0 THEN 'Y' ELSE 'N' END", "s"),
         ("p_channel_demo", "'N'", "s"), ("p_channel_details", "'no details'", "s"),
         ("p_purpose", "'Unknown'", "s"), ("p_discount_active", "'N'", "s")])

    s["reason"] = Spec(
        "range:1:11", [],
        [("r_reason_sk", "k", "i"), ("r_reason_id", _id("R"), "s"),
         ("r_reason_desc", _case("k - 1", REASONS), "s")])

    s["ship_mode"] = Spec(
        "range:1:21", [],
        [("sm_ship_mode_sk", "k", "i"), ("sm_ship_mode_id", _id("M"), "s"),
         ("sm_type", _case("k % 6", SHIP_TYPES), "s"), ("sm_code", _case("k % 3", SHIP_CODES), "s"),
         ("sm_carrier", _case("k - 1", CARRIERS), "s"),
         ("sm_contract", "concat('contract', CAST(k AS STRING))", "s")])

    s["warehouse"] = Spec(
        "range:1:6", [],
        [("w_warehouse_sk", "k", "i"), ("w_warehouse_id", _id("W"), "s"),
         ("w_warehouse_name", _case("k - 1", WAREHOUSES), "s"),
         ("w_warehouse_sq_ft", "100000 * k + 50000", "i")]
        + [(n, e, t) for n, e, t in _addr_cols(d, "w_", "k * 7")])

    s["call_center"] = Spec(
        "range:1:5", [],
        [("cc_call_center_sk", "k", "i"), ("cc_call_center_id", _id("CC"), "s"),
         ("cc_rec_start_date", "DATE '1998-01-01'", "date"),
         ("cc_rec_end_date", "CAST(NULL AS DATE)", "date"),
         ("cc_closed_date_sk", "CAST(NULL AS INT)", "i"), ("cc_open_date_sk", f"{lo}", "i"),
         ("cc_name", _case("k - 1", CALL_CENTERS), "s"), ("cc_class", "'large'", "s"),
         ("cc_employees", "100 * k", "i"), ("cc_sq_ft", "10000 * k", "i"),
         ("cc_hours", "'8AM-4PM'", "s"), ("cc_manager", "concat('Manager ', CAST(k AS STRING))", "s"),
         ("cc_mkt_id", "k", "i"), ("cc_mkt_class", "'Unknown'", "s"), ("cc_mkt_desc", "'Unknown'", "s"),
         ("cc_market_manager", "concat('Market manager ', CAST(k AS STRING))", "s"),
         ("cc_division", "1", "i"), ("cc_division_name", "'Unknown'", "s"),
         ("cc_company", "1", "i"), ("cc_company_name", "'Unknown'", "s")]
        + [(n, e, t) for n, e, t in _addr_cols(d, "cc_", "k * 3")]
        + [("cc_tax_percentage", "0.05", "d5.2")])

    s["web_site"] = Spec(
        "range:1:7", [],
        [("web_site_sk", "k", "i"), ("web_site_id", _id("WS"), "s"),
         ("web_rec_start_date", "DATE '1997-08-16'", "date"),
         ("web_rec_end_date", "CAST(NULL AS DATE)", "date"),
         ("web_name", "concat('site_', CAST(k - 1 AS STRING))", "s"),
         ("web_open_date_sk", f"{lo}", "i"), ("web_close_date_sk", "CAST(NULL AS INT)", "i"),
         ("web_class", "'Unknown'", "s"), ("web_manager", "concat('Manager ', CAST(k AS STRING))", "s"),
         ("web_mkt_id", "k", "i"), ("web_mkt_class", "'Unknown'", "s"), ("web_mkt_desc", "'Unknown'", "s"),
         ("web_market_manager", "concat('Market manager ', CAST(k AS STRING))", "s"),
         ("web_company_id", "k", "i"), ("web_company_name", _case("k - 1", SITE_COMPANIES), "s")]
        + [(n, e, t) for n, e, t in _addr_cols(d, "web_", "k * 5")]
        + [("web_tax_percentage", "0.04", "d5.2")])

    s["web_page"] = Spec(
        "range:1:21", [],
        [("wp_web_page_sk", "k", "i"), ("wp_web_page_id", _id("WP"), "s"),
         ("wp_rec_start_date", "DATE '1997-09-03'", "date"),
         ("wp_rec_end_date", "CAST(NULL AS DATE)", "date"),
         ("wp_creation_date_sk", f"{lo} + k", "i"), ("wp_access_date_sk", f"{hi} - k", "i"),
         ("wp_autogen_flag", "CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END", "s"),
         ("wp_customer_sk", "CAST(NULL AS INT)", "i"),
         ("wp_url", "'http://www.example.com'", "s"),
         ("wp_type", _case("k % 4", ["welcome", "protected", "order", "feedback"]), "s"),
         ("wp_char_count", "1000 + k * 250", "i"), ("wp_link_count", "k % 25 + 2", "i"),
         ("wp_image_count", "k % 7 + 1", "i"), ("wp_max_ad_count", "k % 5", "i")])

    s["catalog_page"] = Spec(
        "range:1:41", [],
        [("cp_catalog_page_sk", "k", "i"), ("cp_catalog_page_id", _id("CP"), "s"),
         ("cp_start_date_sk", f"{DATE_SK_1998} + {d.div('k - 1', '10')} * 90", "i"),
         ("cp_end_date_sk", f"{DATE_SK_1998} + {d.div('k - 1', '10')} * 90 + 89", "i"),
         ("cp_department", "'DEPARTMENT'", "s"), ("cp_catalog_number", f"{d.div('k - 1', '10')} + 1", "i"),
         ("cp_catalog_page_number", "(k - 1) % 10 + 1", "i"),
         ("cp_description", "concat('Catalog page ', CAST(k AS STRING))", "s"),
         ("cp_type", _case("k % 3", ["bi-annual", "quarterly", "monthly"]), "s")])

    s["inventory"] = Spec(
        "inv", [[("x", "(dsk * 31 + k * 17 + wh * 7) % 1000")]],
        [("inv_date_sk", "dsk", "i"), ("inv_item_sk", "k", "i"), ("inv_warehouse_sk", "wh", "i"),
         ("inv_quantity_on_hand", "CASE WHEN x % 4 = 0 THEN x ELSE x % 50 END", "i")])

    # ---- facts -------------------------------------------------------------
    # sale base columns: ok (order), item, sk (supplier), q, disc, rf, ck, ods, h
    sale_stages = [
        [("lp", "CAST((100 + (item * 97) % 19900) * 0.01 AS DECIMAL(7,2))"),
         ("shck", f"(ck + h % 2) % {nc}")],
        [("wc", "CAST(lp * 0.60 AS DECIMAL(7,2))"),
         ("sp", "CAST(lp * (100 - disc) * 0.01 AS DECIMAL(7,2))")],
        [("ext_list", "CAST(q * lp AS DECIMAL(12,2))"),
         ("ext_sales", "CAST(q * sp AS DECIMAL(12,2))"),
         ("ext_wc", "CAST(q * wc AS DECIMAL(12,2))")],
        [("coupon", "CASE WHEN h % 5 = 0 THEN CAST(ext_sales * 0.10 AS DECIMAL(12,2)) "
                    "ELSE CAST(0 AS DECIMAL(12,2)) END"),
         ("ship", "CAST(ext_list * 0.05 AS DECIMAL(12,2))")],
        [("net_paid", "ext_sales - coupon")],
        [("tax", "CAST(net_paid * 0.08 AS DECIMAL(12,2))")],
    ]

    def demo(c):  # demographic / address keys of customer expression c
        return (f"({c} * 5 + h % 3) % 1400",
                f"CASE WHEN h % 23 = 0 THEN NULL ELSE ({c} * 37 + ok % 11 * 131) % 720 END",
                f"CASE WHEN h % 41 = 0 THEN NULL ELSE 2 * {c} + h % 2 END")

    def money(p, names):
        exprs = {"wholesale_cost": "wc", "list_price": "lp", "sales_price": "sp",
                 "ext_discount_amt": "ext_list - ext_sales", "ext_sales_price": "ext_sales",
                 "ext_wholesale_cost": "ext_wc", "ext_list_price": "ext_list", "ext_tax": "tax",
                 "coupon_amt": "coupon", "ext_ship_cost": "ship", "net_paid": "net_paid",
                 "net_paid_inc_tax": "net_paid + tax", "net_paid_inc_ship": "net_paid + ship",
                 "net_paid_inc_ship_tax": "net_paid + ship + tax",
                 "net_profit": "net_paid - ext_wc"}
        return [(p + n, exprs[n], "d7.2" if n in ("wholesale_cost", "list_price", "sales_price")
                 else "d12.2") for n in names]

    promo = "CASE WHEN h % 19 = 0 THEN NULL ELSE h % 30 + 1 END"
    bill = demo("ck")
    ship_d = demo("shck")
    s["store_sales"] = Spec(
        "sale:0", sale_stages,
        [("ss_sold_date_sk", "ods", "i"), ("ss_sold_time_sk", "(h * 101) % 86400", "i"),
         ("ss_item_sk", "item", "i"), ("ss_customer_sk", "ck", "i"),
         ("ss_cdemo_sk", bill[0], "i"), ("ss_hdemo_sk", bill[1], "i"), ("ss_addr_sk", bill[2], "i"),
         ("ss_store_sk", "sk % 12 + 1", "i"), ("ss_promo_sk", promo, "i"),
         ("ss_ticket_number", "ok", "L"), ("ss_quantity", "q", "i")]
        + money("ss_", ["wholesale_cost", "list_price", "sales_price", "ext_discount_amt",
                        "ext_sales_price", "ext_wholesale_cost", "ext_list_price", "ext_tax",
                        "coupon_amt", "net_paid", "net_paid_inc_tax", "net_profit"]))

    cs_money = ["wholesale_cost", "list_price", "sales_price", "ext_discount_amt", "ext_sales_price",
                "ext_wholesale_cost", "ext_list_price", "ext_tax", "coupon_amt", "ext_ship_cost",
                "net_paid", "net_paid_inc_tax", "net_paid_inc_ship", "net_paid_inc_ship_tax",
                "net_profit"]
    s["catalog_sales"] = Spec(
        "sale:1", sale_stages,
        [("cs_sold_date_sk", "ods", "i"), ("cs_sold_time_sk", "(h * 101) % 86400", "i"),
         ("cs_ship_date_sk", "ods + 1 + h % 150", "i"),
         ("cs_bill_customer_sk", "ck", "i"), ("cs_bill_cdemo_sk", bill[0], "i"),
         ("cs_bill_hdemo_sk", bill[1], "i"), ("cs_bill_addr_sk", bill[2], "i"),
         ("cs_ship_customer_sk", "shck", "i"), ("cs_ship_cdemo_sk", ship_d[0], "i"),
         ("cs_ship_hdemo_sk", ship_d[1], "i"), ("cs_ship_addr_sk", ship_d[2], "i"),
         ("cs_call_center_sk", "sk % 4 + 1", "i"), ("cs_catalog_page_sk", "h % 40 + 1", "i"),
         ("cs_ship_mode_sk", "h % 20 + 1", "i"),
         ("cs_warehouse_sk", "CASE WHEN h % 43 = 0 THEN NULL ELSE sk % 5 + 1 END", "i"),
         ("cs_item_sk", "item", "i"), ("cs_promo_sk", promo, "i"),
         ("cs_order_number", "ok", "L"), ("cs_quantity", "q", "i")]
        + money("cs_", cs_money))

    s["web_sales"] = Spec(
        "sale:2", sale_stages,
        [("ws_sold_date_sk", "ods", "i"), ("ws_sold_time_sk", "(h * 101) % 86400", "i"),
         ("ws_ship_date_sk", "ods + 1 + h % 150", "i"), ("ws_item_sk", "item", "i"),
         ("ws_bill_customer_sk", "ck", "i"), ("ws_bill_cdemo_sk", bill[0], "i"),
         ("ws_bill_hdemo_sk", bill[1], "i"), ("ws_bill_addr_sk", bill[2], "i"),
         ("ws_ship_customer_sk", "shck", "i"), ("ws_ship_cdemo_sk", ship_d[0], "i"),
         ("ws_ship_hdemo_sk", ship_d[1], "i"), ("ws_ship_addr_sk", ship_d[2], "i"),
         ("ws_web_page_sk", "CASE WHEN h % 37 = 0 THEN NULL ELSE h % 20 + 1 END", "i"),
         ("ws_web_site_sk", "sk % 6 + 1", "i"), ("ws_ship_mode_sk", "h % 20 + 1", "i"),
         ("ws_warehouse_sk", "CASE WHEN h % 43 = 0 THEN NULL ELSE sk % 5 + 1 END", "i"),
         ("ws_promo_sk", promo, "i"), ("ws_order_number", "ok", "L"), ("ws_quantity", "q", "i")]
        + money("ws_", cs_money))

    ret_stages = sale_stages[:2] + [
        [("rq", "1 + h % q"), ("rck", f"CASE WHEN h % 4 = 0 THEN (ck + 1) % {nc} ELSE ck END")],
        [("ra", "CAST(rq * sp AS DECIMAL(12,2))"),
         ("fee", "CAST((50 + h % 9950) * 0.01 AS DECIMAL(12,2))"),
         ("rship", "CAST(rq * lp * 0.05 AS DECIMAL(12,2))")],
        [("rtax", "CAST(ra * 0.08 AS DECIMAL(12,2))"),
         ("cash", "CAST(ra * 0.60 AS DECIMAL(12,2))"),
         ("rev", "CAST(ra * 0.25 AS DECIMAL(12,2))")],
    ]

    def ret_money(p, credit):
        return [(p + "return_amount" if p == "cr_" else p + "return_amt", "ra", "d12.2"),
                (p + "return_tax", "rtax", "d12.2"),
                (p + "return_amt_inc_tax", "ra + rtax", "d12.2"),
                (p + "fee", "fee", "d12.2"),
                (p + "return_ship_cost", "rship", "d12.2"),
                (p + "refunded_cash", "cash", "d12.2"),
                (p + "reversed_charge", "rev", "d12.2"),
                (p + credit, "ra - cash - rev", "d12.2"),
                (p + "net_loss", "CAST(fee + ra * 0.10 AS DECIMAL(12,2))", "d12.2")]

    rdemo = demo("rck")
    s["store_returns"] = Spec(
        "ret:0", ret_stages,
        [("sr_returned_date_sk", "ods + 5 + h % 170", "i"), ("sr_return_time_sk", "(h * 53) % 86400", "i"),
         ("sr_item_sk", "item", "i"), ("sr_customer_sk", "ck", "i"),
         ("sr_cdemo_sk", bill[0], "i"), ("sr_hdemo_sk", bill[1], "i"), ("sr_addr_sk", bill[2], "i"),
         ("sr_store_sk", "sk % 12 + 1", "i"), ("sr_reason_sk", "h % 10 + 1", "i"),
         ("sr_ticket_number", "ok", "L"), ("sr_return_quantity", "rq", "i")]
        + ret_money("sr_", "store_credit"))

    s["catalog_returns"] = Spec(
        "ret:1", ret_stages,
        [("cr_returned_date_sk", "ods + 5 + h % 170", "i"), ("cr_returned_time_sk", "(h * 53) % 86400", "i"),
         ("cr_item_sk", "item", "i"),
         ("cr_refunded_customer_sk", "ck", "i"), ("cr_refunded_cdemo_sk", bill[0], "i"),
         ("cr_refunded_hdemo_sk", bill[1], "i"), ("cr_refunded_addr_sk", bill[2], "i"),
         ("cr_returning_customer_sk", "rck", "i"), ("cr_returning_cdemo_sk", rdemo[0], "i"),
         ("cr_returning_hdemo_sk", rdemo[1], "i"), ("cr_returning_addr_sk", "2 * rck", "i"),
         ("cr_call_center_sk", "sk % 4 + 1", "i"), ("cr_catalog_page_sk", "h % 40 + 1", "i"),
         ("cr_ship_mode_sk", "h % 20 + 1", "i"),
         ("cr_warehouse_sk", "CASE WHEN h % 43 = 0 THEN NULL ELSE sk % 5 + 1 END", "i"),
         ("cr_reason_sk", "h % 10 + 1", "i"), ("cr_order_number", "ok", "L"),
         ("cr_return_quantity", "rq", "i")]
        + ret_money("cr_", "store_credit"))

    s["web_returns"] = Spec(
        "ret:2", ret_stages,
        [("wr_returned_date_sk", "ods + 5 + h % 170", "i"), ("wr_returned_time_sk", "(h * 53) % 86400", "i"),
         ("wr_item_sk", "item", "i"),
         ("wr_refunded_customer_sk", "ck", "i"), ("wr_refunded_cdemo_sk", bill[0], "i"),
         ("wr_refunded_hdemo_sk", bill[1], "i"), ("wr_refunded_addr_sk", bill[2], "i"),
         ("wr_returning_customer_sk", "rck", "i"), ("wr_returning_cdemo_sk", rdemo[0], "i"),
         ("wr_returning_hdemo_sk", rdemo[1], "i"), ("wr_returning_addr_sk", "2 * rck", "i"),
         ("wr_web_page_sk", "CASE WHEN h % 37 = 0 THEN NULL ELSE h % 20 + 1 END", "i"),
         ("wr_reason_sk", "h % 10 + 1", "i"), ("wr_order_number", "ok", "L"),
         ("wr_return_quantity", "rq", "i")]
        + ret_money("wr_", "account_credit"))
    return s


TABLES = ["call_center", "catalog_page", "catalog_returns", "catalog_sales", "customer",
          "customer_address", "customer_demographics", "date_dim", "household_demographics",
          "income_band", "inventory", "item", "promotion", "reason", "ship_mode", "store",
          "store_returns", "store_sales", "time_dim", "warehouse", "web_page", "web_returns",
          "web_sales", "web_site"]

FACTS = ["store_sales", "store_returns", "catalog_sales", "catalog_returns",
         "web_sales", "web_returns", "inventory"]

# Inventory snapshots: every 7th day from 1999-01-01 (day 2451180), 105 weeks,
# in two of the five warehouses for each item.
INV_FIRST_SK, INV_WEEKS, WAREHOUSE_COUNT = 2451180, 105, 5
STOCKED = "k % 5 + 1", "(k + 2) % 5 + 1"
INV_ROWS_PER_TASK = 2_000_000

# The date key of each fact.
FACT_DATE_KEY = PART_KEY


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def _driver_df(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL text of the sold item and of the buyer of a line (see the module's text).
SOLD_ITEM = (f"CASE WHEN (l_orderkey + l_partkey) % 4 = 0 THEN l_partkey "
             f"ELSE l_partkey - l_partkey % {NEIGHBOURS} END")
BUYER = f"CASE WHEN o_orderkey % 5 = 0 THEN o_custkey ELSE o_custkey - o_custkey % {NEIGHBOURS} END"


def sale_base(spark: SparkSession, sf_dir: str, ch: int | None = None) -> DataFrame:
    """One row per (order, item) with its channel ``ch``; of one channel, if
    it is given."""
    li = _driver_df(spark, sf_dir, "lineitem").withColumn("item", F.expr(f"CAST({SOLD_ITEM} AS INT)"))
    od = _driver_df(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.expr(BUYER).alias("buyer"))
    if ch is not None:
        li, od = li.filter(F.col("l_orderkey") % 3 == ch), od.filter(F.col("o_orderkey") % 3 == ch)
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("l_orderkey").alias("ok"), "item")
            .agg(F.min("l_suppkey").alias("sk"),
                 F.sum(2 * F.col("l_quantity").cast("int") - 1).alias("q"),
                 F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("disc"),
                 F.max("l_returnflag").alias("rf"),
                 F.min("buyer").alias("ck"),
                 F.min("o_orderdate").alias("od"))
            .select("*",
                    (F.lit(DATE_SK_1998) + F.datediff(F.col("od").cast("date"),
                                                      F.lit("1998-01-01").cast("date"))).alias("ods"),
                    (F.col("ok") * 7 + F.col("item") * 13).alias("h"),
                    (F.col("ok") % 3).cast("int").alias("ch"))
            .drop("od"))


def _spark_source(spark, sf_dir, key, sizes: Sizes, sale) -> DataFrame:
    if key == "days":
        return spark.range(sizes.first_day, sizes.last_day + 1).withColumnRenamed("id", "k")
    if key.startswith("range:"):
        _, lo, hi = key.split(":")
        return spark.range(int(lo), int(hi)).withColumnRenamed("id", "k")
    if key == "part":
        return _driver_df(spark, sf_dir, "part").selectExpr("p_partkey AS k", "p_brand AS pb", "p_name AS pn", "p_type AS pt")
    if key == "customer":
        return _driver_df(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name AS cn")
    if key == "addr":
        return _driver_df(spark, sf_dir, "customer").selectExpr("explode(array(2 * c_custkey, 2 * c_custkey + 1)) AS k")
    if key == "inv":
        it = _driver_df(spark, sf_dir, "part").selectExpr("p_partkey AS k")
        # a part is a few bytes here and hundreds of rows below: the parts are
        # dealt by the rows to come, not by the size of their file
        tasks = -(-sizes.parts * INV_WEEKS * len(STOCKED) // INV_ROWS_PER_TASK)
        if tasks > 1:
            it = it.repartition(tasks, "k")
        return (it.select("k", F.explode(F.sequence(F.lit(0), F.lit(INV_WEEKS - 1))).alias("w"))
                .select("k", (F.lit(INV_FIRST_SK) + F.col("w") * 7).alias("dsk"),
                        F.explode(F.array(*map(F.expr, STOCKED))).alias("wh")))
    kind, ch = key.split(":")
    base = (sale(int(ch)) if callable(sale) else sale).filter(F.col("ch") == int(ch))
    if kind == "ret":
        base = base.filter(F.col("rf") == "R")
    return base


def _apply_spec(df: DataFrame, spec: Spec, d: Dialect = SPARK) -> DataFrame:
    for stage in spec.stages:
        df = df.selectExpr("*", *[f"{e} AS {n}" for n, e in stage])
    return df.selectExpr(*[f"CAST({e} AS {sql_type(t)}) AS {n}" for n, e, t in spec.cols])


def input_sizes(spark: SparkSession, sf_dir: str) -> Sizes:
    """Scalars of the input.  Keys must be 0 .. n-1, as the neighbours of a
    part and of a customer are taken by key."""
    counts = {}
    for table, key in (("part", "p_partkey"), ("customer", "c_custkey")):
        counts[table], low, high = _driver_df(spark, sf_dir, table).agg(F.count("*"), F.min(key), F.max(key)).first()
        n = counts[table]
        if n and (low, high) != (0, n - 1):
            raise ValueError(f"{table}: {n} keys from {low} to {high}; expected 0 to {n - 1}")
    first, last = _driver_df(spark, sf_dir, "orders").selectExpr(
        f"datediff(trunc(min(o_orderdate), 'YEAR'), DATE '1998-01-01') + {DATE_SK_1998}",
        f"datediff(add_months(trunc(date_add(max(o_orderdate), {AFTER_DAYS}), 'YEAR'), 12), DATE '1998-01-01') + {DATE_SK_1998} - 1").first()
    return Sizes(counts["customer"], DATE_SK_1998 if first is None else first, DATE_SK_1998 + 364 if last is None else last, counts["part"])


def build_table(spark: SparkSession, sf_dir: str, name: str, sale, sizes: Sizes) -> DataFrame:
    """Lazy DataFrame of one retail table.  ``sale``: the sale base, or a
    function that gives that of a channel."""
    spec = _specs(SPARK, str(sizes.customers), str(sizes.first_day), str(sizes.last_day))[name]
    df = _apply_spec(_spark_source(spark, sf_dir, spec.source, sizes, sale), spec)
    # calendar and outlet dimensions are one file
    return df.coalesce(1) if spec.source == "days" or spec.source.startswith("range:") else df


def build_retail(spark: SparkSession, sf_dir: str, sale: DataFrame | None = None,
                 sizes: Sizes | None = None) -> dict[str, DataFrame]:
    """Lazy DataFrames of all 24 retail tables (no materialisation)."""
    sizes = sizes or input_sizes(spark, sf_dir)
    if sale is None:
        sale = sale_base(spark, sf_dir)
    return {name: build_table(spark, sf_dir, name, sale, sizes) for name in TABLES}


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; the retail tables are "
                           "materialised under it (set it to a shared folder)")
    return root.rstrip("/")


def _files(spark: SparkSession, path: str):
    """(path, length, modification time) of the files under ``path``, through
    Spark's own file system; None when there is no such path."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    out, walk = [], fs.listFiles(at, True)
    while walk.hasNext():
        f = walk.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Changes with this module and with any file of the input tables."""
    h = hashlib.sha1()
    with open(__file__, "rb") as f:
        h.update(f.read())
    for name in ("lineitem", "orders", "part", "customer"):
        h.update(repr(_files(spark, f"{sf_dir}/{name}.parquet")).encode())
    return h.hexdigest()[:16]


_CACHE: dict[tuple, Stored] = {}
_CACHE_LOCK = threading.Lock()
LAYOUTS = ("flat", "date", "range", "bucket")
RANGE_DAYS = 30
_CHOSEN: ContextVar[tuple[str, int, int | None] | None] = ContextVar("layout", default=None)


@contextmanager
def stored_as(layout: str, days: int = RANGE_DAYS, buckets: int | None = None):
    """Statements that are built inside read the tables in this layout."""
    token = _CHOSEN.set((layout, days, buckets))
    try:
        yield
    finally:
        _CHOSEN.reset(token)


def part_column(date_key: str) -> str:
    """Name of the range column of the fact that ``date_key`` belongs to, in a
    table that is stored by ranges."""
    return f"{date_key.split('_')[0]}_part_start"


def retail_tables(spark: SparkSession, sf_dir: str, layout: str | None = None) -> Mapping[str, DataFrame]:
    """All 24 retail tables, read from Parquet written once per input set.

    A table is derived and stored when it is first asked for (``[name]``), so
    a statement pays for the tables that it reads.  The sale base of a channel
    (one join + one aggregation over its third of ``lineitem``) is stored
    too, for the sales and the returns of the channel.  Later queries scan the
    stored Parquet with pushdown and pruning, as they would scan loaded
    tables.  The store lives in ``spark.checkpoint.dir`` so it is shared by
    all executors and survives the loss of any of them.  Each build of a table
    goes to its own folder, and only a folder with the marker that its writer
    leaves last is read, so concurrent builders never mix files and a
    half-written build is never read.

    ``layout``: 'flat'; 'date' (facts partitioned by their date key, so a
    filter on ``date_dim`` prunes fact files at run time through dynamic
    partition pruning; for inputs whose days fill files of tens of MB);
    'range' (facts partitioned by ranges of ``spark.aisle.range.days`` days,
    ``RANGE_DAYS`` by default; the column of the ranges, ``part_column``,
    comes after the declared ones, and the suite's joins on days prune by it);
    or 'bucket' (facts bucketed and sorted by their distribution keys, item and
    ticket or order, in ``spark.aisle.buckets`` buckets, by default as many as
    shuffle partitions: a sale and its return are in buckets of one number,
    and joins on the keys need no shuffle).  Joins on more than these keys
    need none either where the session sets
    ``spark.sql.requireAllClusterKeysForCoPartition`` to false.
    Left out, it is that of ``stored_as``, else the session's
    ``spark.aisle.layout``, else 'flat'.
    """
    return _stored_tables(spark, sf_dir, layout)


def fact_ranges(spark: SparkSession, sf_dir: str, layout: str | None = None) -> Mapping[str, Ranges]:
    """How each fact that is stored by ranges is cut, by its date key."""
    return _stored_tables(spark, sf_dir, layout).ranges


def derived_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """All 24 retail tables for jobs that read each of them once or twice from
    end to end: derived from the stored sale bases as they are read, not
    stored themselves.  Tables that are stored already, or that the session
    wants in another layout than 'flat', are read as ``retail_tables``."""
    stored = _stored_tables(spark, sf_dir, None)
    return _Derived(stored) if stored.layout == "flat" else stored


def _stored_tables(spark: SparkSession, sf_dir: str, layout: str | None) -> Stored:
    chosen, days, buckets = _CHOSEN.get() or (spark.conf.get("spark.aisle.layout", "flat"),
                                              int(spark.conf.get("spark.aisle.range.days", str(RANGE_DAYS))), None)
    layout = layout or chosen
    buckets = buckets or int(spark.conf.get("spark.aisle.buckets", spark.conf.get("spark.sql.shuffle.partitions")))
    size = {"range": days, "bucket": buckets}.get(layout, "")
    if layout not in LAYOUTS:
        raise ValueError(f"layout {layout!r} is none of {LAYOUTS}")
    version = _fingerprint(spark, sf_dir)
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, layout, size, version)
    with _CACHE_LOCK:
        if key not in _CACHE:
            # one Parquet folder per table, e.g. written by ``python -m aisle
            # load`` or ``part``: the 24 tables themselves
            loaded = _files(spark, f"{sf_dir}/store_sales") is not None
            _CACHE[key] = Stored(spark, sf_dir, "loaded" if loaded else layout, size,
                                 "" if loaded else f"{_checkpoint_root(spark)}/aisle-retail/{version}")
        found = _CACHE[key]
    size_shuffles(spark, found.input_bytes)
    return found


SHUFFLE_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INPUT_BYTES_PER_PARTITION = 4 << 20
_SIZED: dict[int, str] = {}


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Cut shuffles by the size of the input: at least one partition for every
    4 MB of the (compressed) input, so that what a task reads and holds does
    not grow with it; adaptive execution joins small partitions again.  A
    number that the session has set itself is left alone."""
    now = spark.conf.get(SHUFFLE_PARTITIONS, None)
    if now is not None and now != _SIZED.get(id(spark)):
        return
    n = -(-input_bytes // INPUT_BYTES_PER_PARTITION)
    if n > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(SHUFFLE_PARTITIONS, str(n))
        _SIZED[id(spark)] = str(n)
    elif now is not None:
        spark.conf.unset(SHUFFLE_PARTITIONS)


class Stored(Mapping):
    """The 24 tables of an input set in one layout, each of them derived and
    stored when it is first asked for.  Partition columns of a stored table
    come back last: the declared columns come first again, in their order."""

    def __init__(self, spark: SparkSession, sf_dir: str, layout: str, size: int | str, root: str):
        self.spark, self.sf_dir, self.layout, self.size, self.root = spark, sf_dir, layout, size, root
        self.ranges: Mapping[str, Ranges] = _FactRanges(self) if layout in ("range", "loaded") else {}
        self.input_bytes = sum(n for t in ("lineitem", "orders", "part", "customer") for _, n, _ in _files(spark, f"{sf_dir}/{t}.parquet") or [])
        self._sizes = None
        self._tables: dict[str, DataFrame] = {}
        self._locks = {n: threading.RLock() for n in (*TABLES, *_BASES, "sizes")}

    def __iter__(self):
        return iter(TABLES)

    def __len__(self):
        return len(TABLES)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        with self._locks[name]:
            if name not in self._tables:
                self._tables[name] = self._read(name)
            return self._tables[name]

    def path(self, name: str) -> str | None:
        """Folder of a complete build of a table; None when there is none.
        The writer's marker comes last; after it, in the layout by ranges, how
        the keys were cut."""
        if self.layout == "loaded":
            return f"{self.sf_dir}/{name}"
        last = "/_ranges/_SUCCESS" if self.layout == "range" and name in PART_KEY else "/_SUCCESS"
        done = [p for p, _, _ in _files(self.spark, self._builds(name)) or [] if p.endswith(f"/{name}{last}")]
        return min(done)[:-len(last)] if done else None

    def _builds(self, name: str) -> str:
        layout = "flat" if name in _BASES else f"{self.layout}{self.size}"
        return f"{self.root}-{layout}/{name}-builds"

    def sizes(self) -> Sizes:
        with self._locks["sizes"]:
            if self._sizes is None:
                self._sizes = input_sizes(self.spark, self.sf_dir)
            return self._sizes

    def sale(self, ch: int) -> DataFrame:
        """The stored sale base of a channel: it feeds two facts."""
        name = _BASES[ch]
        with self._locks[name]:
            if name not in self._tables:
                path = self.path(name)
                if path is None:
                    path = f"{self._builds(name)}/{uuid.uuid4().hex[:12]}/{name}"
                    sale_base(self.spark, self.sf_dir, ch).write.mode("overwrite").parquet(path)
                self._tables[name] = self.spark.read.parquet(path)
            return self._tables[name]

    def derive(self, name: str) -> DataFrame:
        return build_table(self.spark, self.sf_dir, name, self.sale, self.sizes())

    def _read(self, name: str) -> DataFrame:
        path = self.path(name)
        if path is None:
            path = f"{self._builds(name)}/{uuid.uuid4().hex[:12]}/{name}"
            self._write(name, path)
        df = self.spark.read.parquet(path)
        if self.layout == "bucket" and name in DIST_KEY:
            df = attach_bucketed(self.spark, _table_name(path, name), path, df.schema, DIST_KEY[name], self.size)
        by_range = "part_start" in df.columns
        if by_range:
            df = df.withColumnRenamed("part_start", part_column(PART_KEY[name]))
        return df.select(*[n for n, _, _ in _specs(SPARK)[name].cols], *([part_column(PART_KEY[name])] if by_range else []))

    def _write(self, name: str, path: str) -> None:
        df = self.derive(name)
        if self.layout == "range" and name in PART_KEY:
            sizes = self.sizes()
            write_range_partitioned(df, PART_KEY[name], int(self.size), path, sizes.first_day, sizes.last_day)
        elif self.layout == "bucket" and name in DIST_KEY:
            save_bucketed(df, _table_name(path, name), DIST_KEY[name], int(self.size), path)
        elif self.layout == "date" and name in PART_KEY:
            k = PART_KEY[name]
            # range-cluster by (day, item, row hash): few day folders per
            # task, and a large day (even one hot item) is split over tasks;
            # the range bounds cost a second derivation from the stored base
            item = [c for c in df.columns if c.endswith("_item_sk")][0]
            (df.repartitionByRange(F.col(k), F.col(item), F.xxhash64(*df.columns)).write.mode("overwrite")
             .partitionBy(k).parquet(path))
        else:
            df.write.mode("overwrite").parquet(path)


_BASES = ("sale_base_store", "sale_base_catalog", "sale_base_web")


class _Derived(Mapping):
    """The tables of ``stored``, derived where they are not stored."""

    def __init__(self, stored: Stored):
        self.stored = stored

    def __iter__(self):
        return iter(TABLES)

    def __len__(self):
        return len(TABLES)

    def __getitem__(self, name: str) -> DataFrame:
        return self.stored[name] if self.stored.path(name) else self.stored.derive(name)


class _FactRanges(Mapping):
    """Date key -> how its fact is cut, of those of ``stored`` that are."""

    def __init__(self, stored: Stored):
        self.stored = stored

    def __getitem__(self, key: str) -> Ranges:
        name = next((n for n, k in PART_KEY.items() if k == key), None)
        if name is None or part_column(key) not in self.stored[name].columns:
            raise KeyError(key)
        return read_ranges(self.stored.spark, self.stored.path(name))

    def __iter__(self):
        return (k for n, k in PART_KEY.items() if part_column(k) in self.stored[n].columns)

    def __len__(self):
        return sum(1 for _ in self)


def _table_name(base: str, name: str) -> str:
    """Of a bucketed fact in the session's catalog."""
    return f"aisle_{hashlib.sha1(base.encode()).hexdigest()[:12]}_{name}"


# ---------------------------------------------------------------------------
# DuckDB side (oracle prelude)
# ---------------------------------------------------------------------------
_DUCK_NC = "(SELECT count(*) FROM _src_customer)"
_DUCK_LO, _DUCK_HI = "(SELECT lo FROM _span)", "(SELECT hi FROM _span)"
_DUCK_SPAN = f"""SELECT {DATE_SK_1998} + (CAST(date_trunc('year', min(o_orderdate)) AS DATE) - DATE '1998-01-01') AS lo,
    {DATE_SK_1998} - 1 + (CAST(date_trunc('year', max(o_orderdate) + INTERVAL {AFTER_DAYS} DAY) + INTERVAL 1 YEAR AS DATE)
                          - DATE '1998-01-01') AS hi
  FROM orders"""

_DUCK_SALE = f"""SELECT ok, item, sk, q, disc, rf, ck,
    {DATE_SK_1998} + (CAST(od AS DATE) - DATE '1998-01-01') AS ods,
    ok * 7 + item * 13 AS h, CAST(ok % 3 AS INT) AS ch
  FROM (SELECT l_orderkey AS ok, CAST({SOLD_ITEM} AS INT) AS item,
               min(l_suppkey) AS sk, CAST(sum(2 * CAST(l_quantity AS INT) - 1) AS BIGINT) AS q,
               max(CAST(round(l_discount * 100) AS INT)) AS disc, max(l_returnflag) AS rf,
               min({BUYER}) AS ck, min(o_orderdate) AS od
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY l_orderkey, CAST({SOLD_ITEM} AS INT)) b"""


def _duck_source(key: str) -> str:
    if key.startswith("range:"):
        _, lo, hi = key.split(":")
        return f"SELECT range AS k FROM range({lo}, {hi})"
    if key == "days":
        return f"SELECT unnest(range({_DUCK_LO}, {_DUCK_HI} + 1)) AS k"
    if key == "part":
        return "SELECT p_partkey AS k, p_brand AS pb, p_name AS pn, p_type AS pt FROM part"
    if key == "customer":
        return "SELECT c_custkey AS k, c_name AS cn FROM _src_customer"
    if key == "addr":
        return "SELECT 2 * c_custkey + h.range AS k FROM _src_customer, range(2) h"
    if key == "inv":
        stocked = " UNION ALL ".join(f"SELECT p_partkey AS k, {e.replace('k', 'p_partkey')} AS wh FROM part" for e in STOCKED)
        return f"SELECT i.k, {INV_FIRST_SK} + w.range * 7 AS dsk, i.wh FROM ({stocked}) i, range(0, {INV_WEEKS}) w"
    kind, ch = key.split(":")
    cond = f"ch = {ch}" + (" AND rf = 'R'" if kind == "ret" else "")
    return f"SELECT * FROM _sale WHERE {cond}"


def duck_table_sql(name: str) -> str:
    spec = _specs(DUCK, _DUCK_NC, _DUCK_LO, _DUCK_HI)[name]
    sql = _duck_source(spec.source)
    for stage in spec.stages:
        sql = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in stage)} FROM ({sql}) s"
    cols = ", ".join(f"CAST({e} AS {sql_type(t)}) AS {n}" for n, e, t in spec.cols)
    return f"SELECT {cols} FROM ({sql}) s"


def duckdb_prelude(tables: list[str] | None = None) -> str:
    """``WITH`` list defining the retail tables for the DuckDB oracle.

    Followed by a comma-free query body: ``duckdb_prelude() + " SELECT ..."``.
    Pass ``tables`` to define only those (plus ``_sale`` when a fact needs it).
    """
    names = tables or TABLES
    specs = _specs(DUCK, _DUCK_NC, _DUCK_LO, _DUCK_HI)
    # The order-entry ``customer`` table shares its name with the retail one.
    parts = ["_src_customer AS (SELECT * FROM customer)", f"_span AS MATERIALIZED ({_DUCK_SPAN})"]
    if any(specs[n].source.startswith(("sale:", "ret:")) for n in names):
        parts.append(f"_sale AS MATERIALIZED ({_DUCK_SALE})")
    parts += [f"{n} AS ({duck_table_sql(n)})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
