"""Golden cases of names and addresses."""

import pytest

from kinloom.functions.romanize import romanize
from kinloom.functions.text import add_views


@pytest.fixture(scope="module")
def views(spark):
    names = [
        "Raj Healthcare Private Limited", "PRVHTE RAJ HEALTHCARE [LIMITED]", "M/s RAJ HEALTHCARE PRIVATE LIMITED", "Fluxsol F/K/A Raj Healthcare Private Limited",
        "C1ark, Livingston And Kendall Inc", ">> Cohen American Series (LLC)", "Anna Cataldo, Esq., P.C. #66553", "HÁRBOR-FEDERATION", "@alikadavis",
        "navaportillo.com", "Nava and Portillo LLC", None, "",
    ]
    rows = add_views(spark.createDataFrame([(i, n, None) for i, n in enumerate(names)], "i int, business_name string, business_address string")).orderBy("i").collect()
    return dict(zip(names, rows))


@pytest.fixture(scope="module")
def addresses(spark):
    texts = ["6326 Traveler Lane, West Jordan City, UT", "West Jordan City, Utah, 06326 Traveler Ln", "Level No.g-2, <NULL>, Hyderabad, TG", "L-1/24., Sri Krishna Puri, Phulwari, Patna, बिहार", None, "77 1/2 38nd Street"]
    rows = add_views(spark.createDataFrame([(i, None, a) for i, a in enumerate(texts)], "i int, business_name string, business_address string")).orderBy("i").collect()
    return dict(zip(texts, rows))


def test_romanize():
    assert [romanize(w) for w in ("लिमिटेड", "इन्वेस्टमेंट", "బెస్ట్", "Sun पावर Provision")] == ["limited", "investment", "best", "Sun pavar Provision"]


def test_name_core(views):
    same = [views[n].name_core for n in list(views)[:4]]
    assert same == ["raj healthcare"] * 4
    assert views["Raj Healthcare Private Limited"].name_legal == "ltd pvt"
    assert views["Fluxsol F/K/A Raj Healthcare Private Limited"].name_alt_core == "fluxsol"
    assert views["C1ark, Livingston And Kendall Inc"].name_core == "clark livingston and kendall"
    assert views[">> Cohen American Series (LLC)"].name_core == "cohen american series"
    assert views["Anna Cataldo, Esq., P.C. #66553"].name_core == "anna cataldo"
    assert views["HÁRBOR-FEDERATION"].name_core == "harbor federation"


def test_handles_and_domains(views):
    assert views["@alikadavis"].name_is_handle and views["navaportillo.com"].name_is_domain
    assert views["navaportillo.com"].name_concat == views["Nava and Portillo LLC"].name_concat == "navaportillo"
    assert views[None].name_tokens == [] and views[""].name_core == ""


def test_addresses(addresses):
    a, b, c, d = list(addresses.values())[:4]
    assert a.addr_clean == "traveler ln jordan city ut" and a.addr_numbers == ["6326"]
    assert set(a.addr_tokens) == set(b.addr_tokens) and b.addr_numbers == ["6326"]
    assert c.addr_numbers == ["2"] and "null" not in c.addr_tokens
    assert d.addr_states == ["br"]
    assert addresses[None].addr_empty and addresses["77 1/2 38nd Street"].addr_numbers == ["77", "38"]
