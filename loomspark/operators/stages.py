"""The chain from extracted examples to tokens, windows and batches of a training stage."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.functions import tokenizers
from loomspark.operators import dedupe, filters, mixture, records, sequences
from loomspark.session import cut

CODE_TYPES = ("python_code", "docstring_code_pair")
#: Fixed names of the modes.
MODES = ("tiny_local_synthetic", "preview_real_sources", "candidate_stream", "eval_stream", "prepack_stream")


@dataclass(frozen=True)
class Options:
    """Defaults of a stage; rates and multipliers by tier. ``tokenizer``: makes a tokenizer (null: characters)."""

    mode: str = "prepack_stream"
    stage: str = "base_pretrain"
    tier_rates: Mapping[str, float] = field(default_factory=lambda: {"A": 1.0, "B": 1.0, "RESCUE": 0.0, "C": 0.0})
    tier_multipliers: Mapping[str, float] = field(default_factory=dict)
    max_seq_len: int = 512
    batch_size: int = 2
    packing: str = "continuous"
    fim_probability: float = 1.0
    end_id: int = 0
    seed: int = 0
    tokenizer: Callable | None = None
    tokenizer_name: str = "characters"

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unsupported mode {self.mode!r}; expected one of {', '.join(MODES)}")


def options_from(raw: Mapping, *, mode: str, seed: int = 0) -> Options:
    """From a run's settings: training_stage, max_seq_len, micro_batch_size."""
    return Options(mode=mode, stage=str(raw.get("training_stage", "base_pretrain")), seed=seed, max_seq_len=int(raw.get("max_seq_len", 512)), batch_size=int(raw.get("micro_batch_size", 2)))


def _have(df: DataFrame, name: str, kind: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def prepared(examples: DataFrame, order: str, options: Options) -> DataFrame:
    """Accepted examples of a stage, first of their content within a source, with their tier, weight and formatted text.

    Columns: ``order``, source, example_type, text, training_stage, and what the sources keep; prepack_ready and
    preformatted_text if there. Candidates (mode candidate_stream) aren't formatted. Decisions are written as a table of short
    columns and text once, so the duplicate rule joins that table instead of running the filters twice.
    """
    decided = filters.decide(examples).withColumn("_hash", dedupe.content_hash("text"))
    decided = cut(decided, "decided")
    takes_part = ~F.col("decision.reason").isin("empty_text", "binary_or_corrupt_text")
    first = decided.where(takes_part).groupBy("source", "_hash").agg(F.min(order).alias(order))
    kept = decided.where("decision.accepted").join(first, ["source", "_hash", order], "left_semi").drop("_hash")
    kept = kept.withColumns({"quality_tier": F.col("decision.tier"), "loss_weight": F.col("decision.loss_weight"), "training_stage": stage_of(kept, options.stage)}).drop("decision")
    kept = mixture.sample_tiers(kept, options.tier_rates, order, seed=options.seed)
    if options.tier_multipliers:
        kept = mixture.scale_loss(kept, options.tier_multipliers)
    kept = records.enrich(kept)
    return kept.withColumn("fim_applied", F.lit(False)) if options.mode == "candidate_stream" else formatted(kept, options)


def stage_of(df: DataFrame, stage: str):
    """The run's stage, but for examples that are ready for packing and name their own."""
    own = F.coalesce(F.nullif(_have(df, "train_stage"), F.lit("")), F.nullif(_have(df, "training_stage"), F.lit("")))
    return F.when(F.coalesce(_have(df, "prepack_ready", "boolean"), F.lit(False)) & own.isNotNull(), own).otherwise(stage)


def formatted(kept: DataFrame, options: Options) -> DataFrame:
    """Texts as their stage wants them: fill-in-the-middle of code, instructions of prompt and response; preformatted ones stay."""
    free = ~F.coalesce(_have(kept, "preformatted_text", "boolean"), F.lit(False))
    code = free & (F.col("training_stage") == "fim_train") & F.col("example_type").isin(*CODE_TYPES)
    fim = sequences.fim_text(kept, "text", options.fim_probability)
    response = F.coalesce(F.nullif(_have(kept, "response"), F.lit("")), _have(kept, "completion"))
    task = F.coalesce(F.nullif(_have(kept, "task_type"), F.lit("")), F.lit("code_writing"))
    ask = free & (F.col("training_stage") == "instruction_tune") & _have(kept, "prompt").isNotNull() & response.isNotNull()
    text = F.when(code & F.col("fim_applied"), F.col("fim_text")).when(ask, records.instruction(_have(kept, "prompt"), response, task=task)).otherwise(F.col("text"))
    out = fim.withColumns({"_text": text, "fim_applied": code & F.col("fim_applied"), "example_type": F.when(ask, F.concat(F.lit("instruction_"), task)).otherwise(F.col("example_type")), "formatted_instruction": ask})
    return records.enrich(out.withColumn("text", F.col("_text")).drop("_text", "fim_text", "prefix", "middle", "suffix"))


def mixed(kept: DataFrame, order: str, options: Options, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Adds ``due`` by the stage's target weights."""
    return mixture.interleave(kept, weights or mixture.STAGES[options.stage], order)


def tokenized(kept: DataFrame, options: Options, *, keep_text: bool = False) -> DataFrame:
    ids = sequences.char_tokens(F.col("text"), options.end_id) if options.tokenizer is None else tokenizers.tokens(F.col("text"), options.tokenizer, name=options.tokenizer_name)
    out = kept.withColumn("tokens", ids)
    return out if keep_text else out.drop("text")


def packed(tokens: DataFrame, order: str, options: Options) -> DataFrame:
    """Windows of the examples in order: full ones with each source's number of tokens, or whole examples (packing atomic)."""
    if options.packing == "continuous":
        return sequences.windows(tokens, order, "tokens", options.max_seq_len, drop_remainder=True, label="source")
    return sequences.atomic(tokens, order, "tokens", options.max_seq_len)


def batches(windows: DataFrame, options: Options) -> DataFrame:
    """Inputs and targets in full batches."""
    x, y = sequences.shifted("token_ids")
    return sequences.full_batches(windows.select("window", x.alias("x"), y.alias("y")), "window", options.batch_size)


def run(examples: DataFrame, order: str, options: Options, weights: Mapping[str, float] | None = None) -> DataFrame:
    """What a mode gives: candidates as they are, or examples formatted for packing and evaluation, in the stage's mixture."""
    return mixed(prepared(examples, order, options), order, options, weights)
