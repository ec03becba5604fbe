"""Versions are read whole or not at all; encoders and models come back from one version."""

import threading

import pytest

from tidalrec.plans import catalog as C
from tidalrec.sources import model_store as MS
from tidalrec.sources import tables as TB
from tidalrec.sources.versions import VersionedStore

SF = "/root/testdata/sf0.001"


def test_half_written_versions_are_not_read(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "s"))
    assert store.versions() == [] and store.version() is None
    assert store.publish({"a": spark.range(3)}, {"m": 1}) == 1
    # a writer that dies after its tables, and one that dies before the rename
    spark.range(9).write.parquet(str(tmp_path / "s/data/dead/a"))
    (tmp_path / "s/commits/.draft-1").write_text('{"folder": "da')
    assert store.versions() == [1]
    assert store.table(store.version(), "a").count() == 3
    assert store.publish({"a": spark.range(5), "b": spark.range(1)}, {"m": 2}) == 2
    assert store.table(store.version(), "a").count() == 5 and store.table(store.version(1), "a").count() == 3
    assert store.version(1).meta == {"m": 1}
    with pytest.raises(ValueError, match="no table"):
        store.table(store.version(1), "b")
    with pytest.raises(ValueError, match="not among"):
        store.version(7)


def test_a_failed_table_leaves_no_version(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "s"))
    with pytest.raises(Exception):
        store.publish({"a": spark.range(3), "b": spark.range(3).selectExpr("raise_error('lost') AS x")}, {})
    assert store.versions() == []


def test_writers_take_different_numbers(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "s"))
    got = []
    threads = [threading.Thread(target=lambda i=i: got.append(store.publish({"a": spark.range(i + 1)}, {"i": i}))) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [1, 2, 3, 4, 5, 6] == store.versions()
    assert sorted(store.version(n).meta["i"] for n in got) == list(range(6))


def test_encoders_are_built_once(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "s"))
    train, _ = C.split_parts(spark, SF)
    users, items = TB.users(spark, SF), TB.items(spark, SF)
    spec = C.tpch_spec(min_counts={"p_brand": 0})
    (_, first), built, why = MS.load_or_build_encoders(store, users, items, train, spec)
    assert built and why == "nothing stored"
    (_, again), built, why = MS.load_or_build_encoders(store, users, items, train, C.tpch_spec(min_counts={"p_brand": 1}))
    assert not built and why == "ok"  # 0 and 1 are the same
    assert sorted(map(tuple, first.vocab.collect())) == sorted(map(tuple, again.vocab.select(first.vocab.columns).collect()))
    more = C.tpch_spec(min_counts={"p_brand": 1}, item_cat=("p_brand", "p_type", "p_size", "p_container")) if \
        "p_container" in items.columns else C.tpch_spec(min_counts={"p_brand": 1}, item_cat=("p_brand", "p_type", "p_size", "p_name"))
    _, built, why = MS.load_or_build_encoders(store, users, items, train, more)
    assert built and "missing columns" in why
    with pytest.raises(ValueError, match="missing columns"):
        MS.load_or_build_encoders(store, users.drop("c_acctbal"), items, train, spec)
    assert store.versions() == [1, 2]


def test_model_comes_back_whole(spark, tmp_path):
    """New items, one with unseen values, are scored by what one version holds."""
    from tidalrec.operators import store as ST
    from tidalrec.operators import towers as TW
    ctx = C._model_ctx(spark, SF)
    towers = {"user": TW.init_params(C.U_FEATS, ["c_acctbal"], C.DIM, [16, C.DIM], 1),
              "item": TW.init_params(C.I_FEATS, [], C.DIM, [8], 2, pooling="concat")}
    encoders = [C.V.Encoders(ctx[k + "vocab"], ctx[k + "scal"], c, d) for k, c, d in (
        ("u", C.U_FEATS, ["c_acctbal"]), ("i", C.I_FEATS, ["p_retailprice"]))]
    store = VersionedStore(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="no version"):
        MS.load_model(store)
    spec = C.tpch_spec(min_counts=C.MODEL_MIN)
    MS.save_model(store, MS.Model(spec, *encoders, ctx["utab"].unionByName(ctx["itab"]), towers, {"note": "x"}))
    model = MS.load_model(VersionedStore(spark, str(tmp_path / "m")))
    assert model.spec == spec and model.meta == {"note": "x"}
    for side, p in towers.items():
        back = model.towers[side]
        assert (back.features, back.dense, back.pooling) == (p.features, p.dense, p.pooling)
        assert (back.pool == p.pool).all() and len(back.layers) == len(p.layers)
        assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(back.layers, p.layers))
    new = spark.createDataFrame([(10 ** 9, "never", "seen", 3, 5.0), (1, None, "x", None, None)],
                                "p_partkey long, p_brand string, p_type string, p_size int, p_retailprice double")
    rows = ST.build_store(new, model.items, model.spec.item_id)
    cards = {f: model.items.cardinality(f) for f in model.items.cat_cols}
    out = TW.tower_embed(rows.table, "id_key", model.tables, model.towers["item"], cards, prefix="item.").collect()
    assert {r.id_key for r in out} == {"1", str(10 ** 9)} and all(len(r.emb) == 8 for r in out)
