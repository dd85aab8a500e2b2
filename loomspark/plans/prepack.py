"""From configured sources to a prepacked dataset, in one chain."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loomspark.functions import tokenizers
from loomspark.operators import mixture, prepack, sequences, stages
from loomspark.operators.mixture import ranked
from loomspark.session import cut, shared_dir
from loomspark.sources import config, files, packing, rows, shards


def pack_dataset(spark: SparkSession, config_path: str, datasets_path: str, *, output: str | None = None, synthetic: str | None = None, target: int | None = None, stage: str = "base_pretrain", root: str = ".", seconds: float | None = None, tokenizer: tokenizers.Tokenizer | None = None, state: str | None = None, ranges: int | None = None, clock: Callable[[], float] = time.monotonic) -> tuple[dict, str]:
    """The manifest and why packing stopped: target_sequences, time_guard, data_exhausted.

    ``state``: a folder that outlives the run (:mod:`packing`); another run with it goes on where this one stopped, and what was
    packed but not asked for is the next one's first. Time is looked at between ranges; what is packed by then is written.
    """
    began = clock()
    c = config.prepack(config.load(config_path), output_dir=output)
    tok = tokenizer or tokenizers.FromFile(_tokenizer_path(c.tokenizer_id))
    tokenizers.fits_uint16(tok)
    configs = config.load_sources(datasets_path)
    if synthetic:
        configs["synthetic"] = replace(configs.get("synthetic", config.Source("synthetic", extractor="synthetic")), local_path=synthetic)
    weights = config.source_weights(c.mixture, configs)
    c = c.with_mixture(weights)
    options = stages.Options(stage=stage, seed=c.seed, max_seq_len=c.max_seq_len, tokenizer=lambda: tok, tokenizer_name=files.payload_hash({"tokenizer": c.tokenizer_id}))

    def lay():
        found = None
        for name, source in config.chosen(configs, weights).items():
            df = rows.examples(rows.source_records(spark, source, root=root))
            keep = [k for k in ("text", "example_type", "training_stage", "original_fields", "docstring", "path") if k in df.columns]
            own = df.select(*keep, F.lit(name).alias("source"))
            found = own if found is None else found.unionByName(own, allowMissingColumns=True)
        found = cut(found.withColumn("ord", F.monotonically_increasing_id()), "examples")
        kept = stages.mixed(stages.prepared(found, "ord", options), "ord", options, weights)
        more = mixture.oversample(kept, mixture.multiplier(kept, c.tier_weights()), "ord", c.seed)
        place = F.xxhash64("due", "ord", "copy")
        # by due place, then hash
        return ranked(cut(more.withColumn("place", F.col("due") + (place % 1000000) * 1e-12), "laid"), [], "place", "nth", ties=("ord", "copy"))

    snapshot = files.payload_hash({"datasets_config": datasets_path, "synthetic_input": synthetic, "weights": weights})
    digest = files.payload_hash({"tokenizer_id": c.tokenizer_id, "vocab": tok.vocab()})
    one_go = state is None and seconds is None and target is None
    state = state or f"{shared_dir(spark)}/loomspark/packing-{uuid.uuid4().hex}"
    identity = {"snapshot": snapshot, "tokenizer": digest, "stage": stage, "root": root, "settings": files.payload_hash({k: v for k, v in asdict(c).items() if k != "output_dir"})}
    laid, plan = packing.plan(spark, state, identity, lay, ranges=ranges or (1 if one_go else packing.RANGES))
    whole = sequences.requires_atomic(F.col("example_type"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("fim_applied"))
    given = packing.handed(state)
    stop = packing.until(target=target, seconds=seconds, began=began, given=given, clock=clock)
    at, why = packing.advance(laid, plan, state, lambda df: stages.tokenized(df, options), max_seq_len=c.max_seq_len, atomic=whole, keep_partial=not c.drop_incomplete_sequence, stop=stop)
    upto = at.sequences if target is None else min(at.sequences, given + target)
    if target is not None and upto - given >= target:
        why = "target_sequences"
    if upto == given:  # a folder without sequences has no manifest
        return {"total_sequences": 0}, why
    packed = prepack.with_split(packing.sequences(spark, state, given, upto), **c.fractions())
    ids_ = {"source_dataset_versions": config.versions({k: configs[k] for k in weights}), "split_manifest_id": f"stable_hash:{c.synthetic_split_key}", "synthetic_manifest_id": synthetic and synthetic.rpartition("/")[2]}
    manifest = shards.write(packed, c.output_dir, c, tokenizer_hash=digest, snapshot_hash=snapshot, **ids_)
    packing.hand(state, c.output_dir, upto)
    return manifest, why


def _tokenizer_path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
