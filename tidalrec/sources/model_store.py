"""Encoders and models under one version: vocabularies, scalers, feature spec, embedding tables and weights."""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalrec.operators.towers import TowerParams
from tidalrec.operators.vocab import Encoders, build_encoders
from tidalrec.sources.artifacts import fingerprint, frame_params, params_frame, reusable
from tidalrec.sources.versions import Version, VersionedStore
from tidalrec.spec import FeatureSpec

SIDES = ("user", "item")


def spec_dict(spec: FeatureSpec) -> dict:
    return {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(spec).items()}


def spec_from(told: dict) -> FeatureSpec:
    return FeatureSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in told.items()})


def inputs_fingerprint(users: DataFrame, items: DataFrame, train: DataFrame, spec: FeatureSpec) -> dict:
    """Row counts and order-independent hashes of the columns that the encoders are fitted on."""
    return {"users": fingerprint(users.select(*spec.user_cols)), "items": fingerprint(items.select(*spec.item_cols)),
            "train": fingerprint(train.select(spec.inter_user, spec.inter_item))}


# ---- encoders -------------------------------------------------------------------------


def _encoder_tables(encoders: tuple[Encoders, Encoders]) -> dict[str, DataFrame]:
    out = {}
    for side, e in zip(SIDES, encoders):
        out[f"{side}_vocab"], out[f"{side}_scalers"] = e.vocab, e.scalers
    return out


def _encoder_meta(encoders: tuple[Encoders, Encoders], spec: FeatureSpec, inputs: dict | None) -> dict:
    return {"spec": spec_dict(spec), "inputs": inputs, "columns": {
        side: {"cat_cols": e.cat_cols, "dense_cols": e.dense_cols, "min_counts": {c: spec.min_count(c) for c in e.cat_cols}}
        for side, e in zip(SIDES, encoders)}}


def _read_encoders(store: VersionedStore, version: Version) -> tuple[Encoders, Encoders]:
    out = []
    for side in SIDES:
        columns = version.meta["columns"][side]
        vocab = store.table(version, f"{side}_vocab").select("column", "value", "cnt", "token_index", "is_tail", "min_count")
        out.append(Encoders(vocab, store.table(version, f"{side}_scalers"), columns["cat_cols"], columns["dense_cols"]))
    return out[0], out[1]


def load_or_build_encoders(store: VersionedStore, users: DataFrame, items: DataFrame, train: DataFrame,
                           spec: FeatureSpec) -> tuple[tuple[Encoders, Encoders], bool, str]:
    """(user and item encoders, whether they were built now, why).

    The newest version is used if it has every column of the spec, the same
    minimum counts (0 and 1 are the same) and was fitted on the same inputs;
    otherwise new ones are fitted and published.
    """
    spec.validate(users, items, train)
    inputs = inputs_fingerprint(users, items, train, spec)
    version, why = store.version(), "nothing stored"
    if version is not None:
        why = "ok" if version.meta.get("inputs") == inputs else "input data changed"
        for side, cats, dense in (("user", (spec.user_id, *spec.user_cat), spec.user_dense),
                                  ("item", (spec.item_id, *spec.item_cat), spec.item_dense)):
            mins = {c: spec.min_count(c) for c in cats}
            fits, reason = reusable(version.meta["columns"][side], list(cats), list(dense), mins)
            why = why if fits else f"{side}: {reason}"
        if why == "ok":
            return _read_encoders(store, version), False, why
    built = build_encoders(users, items, train, spec)
    store.publish(_encoder_tables(built), _encoder_meta(built, spec, inputs),
                  {"user_vocab": "column", "item_vocab": "column"})
    return built, True, why


# ---- models ------------------------------------------------------------------------------


@dataclass
class Model:
    spec: FeatureSpec
    users: Encoders
    items: Encoders
    tables: DataFrame  # feature, token_index, vec
    towers: dict[str, TowerParams]
    meta: dict


def _arrays(side: str, p: TowerParams) -> dict[str, np.ndarray]:
    out = {f"{side}.pool": p.pool}
    for kind, layers in (("layer", p.layers), ("bottom", p.bottom)):
        for n, (w, b) in enumerate(layers):
            out[f"{side}.{kind}{n}.weight"], out[f"{side}.{kind}{n}.bias"] = w, b
    return out


def save_model(store: VersionedStore, model: Model) -> int:
    """Publishes everything that scoring needs as one version.  The tables may be of any size; the towers' weights are small."""
    arrays = {k: v for side, p in model.towers.items() for k, v in _arrays(side, p).items()}
    encoders = (model.users, model.items)
    meta = _encoder_meta(encoders, model.spec, None) | {
        "shapes": {k: list(np.shape(v)) for k, v in arrays.items()}, "more": model.meta,
        "towers": {side: {"features": p.features, "dense": p.dense, "pooling": p.pooling, "layers": len(p.layers),
                          "bottom": len(p.bottom), "normalize": p.normalize} for side, p in model.towers.items()}}
    tables = _encoder_tables(encoders) | {"embeddings": model.tables, "weights": params_frame(model.tables.sparkSession, arrays)}
    return store.publish(tables, meta, {"user_vocab": "column", "item_vocab": "column", "embeddings": "feature"})


def load_model(store: VersionedStore, number: int | None = None) -> Model:
    """The model of a version, from that version alone."""
    version = store.version(number)
    if version is None:
        raise ValueError(f"no version in {store.path}")
    meta = version.meta
    arrays = frame_params(store.table(version, "weights"), {k: tuple(s) for k, s in meta["shapes"].items()})
    towers = {}
    for side, t in meta["towers"].items():
        layers = {kind: [(arrays[f"{side}.{kind}{n}.weight"], arrays[f"{side}.{kind}{n}.bias"]) for n in range(t[many])]
                  for kind, many in (("layer", "layers"), ("bottom", "bottom"))}
        towers[side] = TowerParams(features=t["features"], dense=t["dense"], pool=arrays[f"{side}.pool"],
                                   layers=layers["layer"], bottom=layers["bottom"], normalize=t["normalize"], pooling=t["pooling"])
    users, items = _read_encoders(store, version)
    tables = store.table(version, "embeddings").select("feature", F.col("token_index").cast("bigint").alias("token_index"), "vec")
    return Model(spec_from(meta["spec"]), users, items, tables, towers, meta["more"])
