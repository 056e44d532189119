"""The stored registry: versions, alias, races."""

import pytest

from keepcurve.sources.model_registry import LostRace, ModelRegistry

SCHEMA = "model string, version int, metric string, value double"


def metrics(spark, version, value, model="m"):
    return spark.createDataFrame([(model, version, "pr_auc", value), (model, version, "roc_auc", 0.5)], SCHEMA)


def champions(registry):
    return {(r["model"], r["version"]) for r in registry.table().where("alias = 'champion'").collect()}


def test_store_promote_and_read_again(spark, tmp_path):
    r = ModelRegistry(spark, str(tmp_path))
    assert r.aliases() == (0, {}) and r.table().count() == 0
    assert r.gate(metrics(spark, 1, 0.40)).first()["promoted"]  # no champion yet
    assert r.gate(metrics(spark, 2, 0.396)).first()["promoted"]  # within the tolerance
    assert not r.gate(metrics(spark, 3, 0.35)).first()["promoted"]
    again = ModelRegistry(spark, str(tmp_path))
    assert again.aliases() == (2, {"m": 2}) and champions(again) == {("m", 2)}
    assert sorted(x["version"] for x in again.table().where("metric = 'pr_auc'").collect()) == [1, 2, 3]
    assert again.gate(metrics(spark, 1, 0.1, "other")).first()["promoted"]
    assert champions(again) == {("m", 2), ("other", 1)}
    with pytest.raises(ValueError):
        again.log(metrics(spark, 3, 0.9))


def test_of_two_writers_on_one_state_one_loses(spark, tmp_path):
    a, b = ModelRegistry(spark, str(tmp_path)), ModelRegistry(spark, str(tmp_path))
    for v in (1, 2, 3):
        a.log(metrics(spark, v, 0.4 + v / 100))
    seen, _ = a.aliases()
    a.set_champion("m", 1, seen)
    with pytest.raises(LostRace):
        b.set_champion("m", 2, seen)
    assert champions(b) == {("m", 1)}
    # a claim without its manifest: nobody else may write that number, and readers keep the last whole state
    last, _ = b.aliases()
    b._fs.createNewFile(b._fs_path(f"{tmp_path}/aliases/claim-{last + 1:08d}"))
    with pytest.raises(LostRace):
        a.set_champion("m", 3, last)
    assert champions(a) == {("m", 1)}


def test_a_lost_race_is_decided_again(spark, tmp_path, monkeypatch):
    r, other = ModelRegistry(spark, str(tmp_path)), ModelRegistry(spark, str(tmp_path))
    r.gate(metrics(spark, 1, 0.40))
    other.log(metrics(spark, 2, 0.60))
    read, calls = r.aliases, []

    def interrupted():
        state = read()
        if not calls:  # another writer promotes version 2 after the first look
            calls.append(1)
            other.set_champion("m", 2, state[0])
        return state

    monkeypatch.setattr(r, "aliases", interrupted)
    assert not r.gate(metrics(spark, 3, 0.45)).first()["promoted"]
    assert champions(other) == {("m", 2)}
