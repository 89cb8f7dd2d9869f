import pytest
from mergewell.functions import normalize as n
from pyspark.sql import functions as F


def column(spark, make, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    return [r.x for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


CASES = [
    (n.normalize_name, [("McDonald's Restaurant", "mcdonald s restaurant"), ("Mahindra & Mahindra", "mahindra and mahindra"), ("Zomato Media Pvt Ltd", "zomato media"), ("Company Co", "company co"), ("Foo™", "fooTM"), ("Straße", "straße"), ("Café  Ltd.", "cafe"), ("", ""), (None, ""), ("inc", "inc")]),
    (n.normalize_address, [("110 N Carpenter St", "110 north carpenter street"), ("112 R du Faubourg St-Honore", "112 r du faubourg street honore"), ("702 SW 8th St Ste 100", "702 southwest 8th street suite 100"), ("", "")]),
    (n.normalize_country, [("U.S.A.", "US"), ("United States", "US"), ("america", "US"), ("Brazil", "BRAZIL"), (" fra ", "FR"), ("", ""), ("Côte d'Ivoire", "COTE DIVOIRE")]),
    (n.normalize_zip, [(" 98-101 ", "98101"), ("ls1 6dt", "LS16DT"), ("00000", "00000"), (None, "")]),
    (lambda c: F.array_join(n.extract_numbers(c), ","), [("702 southwest 8th street suite 100", "702,100"), ("ground floor 12a 94 meghdoot", "94"), ("", "")]),
    (lambda c: F.array_join(n.tokens(n.normalize_text(c)), "|"), [("a  b", "a|b"), ("", ""), ("_x_ Ünï", "_x_|uni")]),
]


@pytest.mark.parametrize(("make", "cases"), CASES)
def test_cases(spark, make, cases):
    assert column(spark, make, [a for a, _ in cases]) == [b for _, b in cases]


def test_normalised_entities(spark):
    from mergewell.sources.entities import values_source

    row = n.with_normalised(values_source(spark, [{"id": "1", "name": "Blue Fern LLC", "address": "12 St", "city": "Köln", "country": "us"}], "s1")).first()
    assert (row.norm_name, row.norm_address, row.norm_city, row.norm_country) == ("blue fern", "12 street", "koln", "US")
    assert row.full_text == "blue fern 12 street koln US" and row.addr_numbers == ["12"] and row.source_tag == "s1"
    empty = n.with_normalised(values_source(spark, [{"id": "2", "name": "X", "country": "us"}], "s1")).first()
    assert empty.full_text == "x   US" and empty.name_tokens == ["x"] and empty.addr_tokens == []
