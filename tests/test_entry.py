"""Driver contract: entry smoke, every query has an oracle."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "date_event", "event_type", "location", "lat", "lng"]
    assert df.count() == 15


def test_every_query_has_an_oracle():
    from eventide.plans.catalogue import catalogue
    from eventide.plans.oracle import oracles

    assert set(catalogue()) == set(oracles())
    assert set(catalogue()) <= set(entry.queries()) and set(oracles()) <= set(entry.oracle_sql())


def test_only_the_entry_knows_of_the_optional_subpackage():
    import pathlib

    root = pathlib.Path(entry.__file__).parent / "eventide"
    others = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    assert others and not any("llm" in p.read_text() for p in others)
