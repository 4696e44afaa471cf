from linkweave.llm import addresses
from linkweave.llm.addresses import parse_address


def test_postcodes_are_found_where_digits_start():
    texts = ["12 x road, 123456", "12 x road 12345-678", "12 x road 12345 - 678, 99999", "12 x road 602 426", "602 426 x road", "a12345", "1234567", "_12345 54321", "ab12345", "123 456, 12345"]
    for t in texts:
        m = list(addresses._POSTCODE.finditer(t))
        assert [x.span() for x in addresses._DIGIT_POSTCODE.finditer(t)] == [x.span() for x in m], t
    assert parse_address("8 west gewezurt road, sutarwick uu2 1sb").postcode == "uu21sb"
    assert parse_address("avenida soubopran, 1075, cagost - 10860-118").postcode == "10860118"


def test_shortest_place_word():
    assert parse_address("839 drebenind parkway dirol springs vz 70445").places == "dirol springs vz"
    assert parse_address("839 drebenind parkway dirol springs vz 70445", None, 3).places == "dirol springs"


def test_street_types_are_never_skipped_by_their_start():
    assert all(addresses.may_start(f, addresses._STARTS) for w in addresses._LONG_TYPES for f in ("q" + w, w[1:], w[0] + w[2:], w[0] + "q" + w[1:]))
    assert not addresses.may_start("xqzrobur", addresses._STARTS)
