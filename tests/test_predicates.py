import pytest

from vectide.functions.predicates import fields_list, predicate, rewrite


@pytest.mark.parametrize(
    "text, expected",
    [
        ("id in [1, 2]", "id in (1, 2)"),
        ("id in [1, 2] and not k in ['a]', \"[b\"]", "id in (1, 2) and not k in ('a]', \"[b\")"),
        ("category == 'tech'", "category == 'tech'"),
        ("title like '%a && b%'", "title like '%a && b%'"),
        ("ID IN [3]", "ID in (3)"),
    ],
)
def test_rewrite(text, expected):
    assert rewrite(text) == expected


@pytest.mark.parametrize(
    "text", ["", "  ", "a > 1 && b > 2", "a > 1 || b > 2", "1 <= x <= 5", "tags[0] == 1", "id in [1, 2", "id in (1]"]
)
def test_refused(text):
    with pytest.raises(ValueError):
        rewrite(text)


def test_filters_run(spark):
    df = spark.createDataFrame([(1, "tech", 20), (2, "art", 30), (3, "tech", 40)], "id long, category string, age int")
    cases = {
        "id > 0": {1, 2, 3},
        "id in [1, 2]": {1, 2},
        "category == 'tech'": {1, 3},
        'age > 18 and category == "tech"': {1, 3},
        "not category like '%te%'": {2},
        "category != 'art' and (age < 30 or id == 3)": {1, 3},
    }
    for text, ids in cases.items():
        assert {r.id for r in df.where(predicate(text)).collect()} == ids, text


def test_fields_list():
    every = ["id", "title", "meta"]
    assert fields_list(None, every) == [] and fields_list("", every) == []
    assert fields_list(" title , id,title", every) == ["title", "id"]
    assert fields_list("*", every) == every
    assert fields_list("meta.a", every) == ["meta.a"]
    with pytest.raises(ValueError):
        fields_list("nope", every)
