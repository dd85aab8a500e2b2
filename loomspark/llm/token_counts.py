"""Numbers of tokens of whole texts, without encoding most of them.

Before any text is read, every string of the vocabulary is encoded alone: those that come back as their own single token are
proven, and a pre-token equal to one of them counts 1 wherever it stands, as byte-level BPE merges each pre-token by itself.
A text is then split into pre-tokens, proven ones are counted by look-up, and only the rest is merged, by the library's own
model; counts of short ones are remembered. The proof is broadcast: at most one string for each entry of the vocabulary file.

Pre-tokens up to U+024F are found by the pattern; other texts are split by the library's own splitter, so classes of
characters are always the library's. Texts of any length are taken in slices that end before a space that follows a letter or
digit, where a pre-token ends whatever follows, so memory doesn't grow with them.

The shortcut holds for a byte-level BPE without normaliser, dropout or prefix space whose added tokens match plainly. Any
other ``.json`` file is encoded by tokenizers, a ``.model`` by sentencepiece; results are the library's in every case, without
begin, end or added special tokens, and with special strings inside texts as each library takes them by default.

Defined results: a null text counts as empty, and an empty one has no bytes and no tokens; repeated rows are counted each; an
empty table gives no rows. Other columns are kept in ``row`` (those in ``carry``, or all but the text).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_of, small
from .packing import byte_letters, tokenizer_path

LIMIT, SLICE = 512, 1 << 17
#: Pre-tokens longer than this aren't remembered, nor more than so many others.
SHORT, REMEMBERED = 64, 400_000
#: Fixed: the pre-tokens of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BEYOND = re.compile(r"[^\x00-ɏ]")
_CUT = re.compile(r"(?<=[^\W_]) ")


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Parts of at least ``size`` characters that are split into pre-tokens as the whole is."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def is_plain(config: dict) -> bool:
    """Whether the shortcut holds for a tokenizer's settings."""
    split, model = config.get("pre_tokenizer") or {}, config["model"]
    marks = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in config["added_tokens"])
    own = not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
    cut = config.get("truncation") is None and config.get("padding") is None
    return config["normalizer"] is None and split.get("type") == "ByteLevel" and not split["add_prefix_space"] and split.get("use_regex", True) and model["type"] == "BPE" and own and marks and cut


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def proven(path: str) -> list[str]:
    """The vocabulary strings that encode alone as their own token; none where the shortcut doesn't hold."""
    if path.endswith(".model"):
        return []
    tokenizer = _load(path)
    if not is_plain(json.loads(tokenizer.to_str())):
        return []
    byte = {ord(c): i for i, c in enumerate(byte_letters())}
    texts = {}
    for letters, i in tokenizer.get_vocab(with_added_tokens=False).items():
        if all(ord(c) in byte for c in letters):
            try:
                texts[letters.translate(byte).encode("latin-1").decode()] = i
            except UnicodeDecodeError:  # part of a character: never a whole pre-token
                continue
    names = sorted(texts)
    return [t for t, e in zip(names, tokenizer.encode_batch(names, add_special_tokens=False), strict=True) if e.ids == [texts[t]]]


class _Known(dict):
    """Numbers of tokens by pre-token: the proven ones at first, merged ones as they come."""

    def __init__(self, whole: list[str], merge: Callable[[str], int]):
        super().__init__(dict.fromkeys(whole, 1))
        self.merge, self.room, self.merged = merge, len(whole) + REMEMBERED, 0

    def __missing__(self, word: str) -> int:
        n = self.merge(word)
        self.merged += 1
        if len(word) <= SHORT and len(self) < self.room:
            self[word] = n
        return n


class TokenCounter:
    """``count(text)``: the number of the library's tokens."""

    def __init__(self, path: str, whole: list[str] | None = None):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda text: len(model.encode(text, num_threads=1))
            return
        tokenizer = _load(path)
        config = json.loads(tokenizer.to_str())
        if not is_plain(config):
            self.count = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
            return
        marks = sorted((t["content"] for t in config["added_tokens"]), key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, marks))) if marks else None
        model, self.split = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str
        letters = dict(enumerate(byte_letters()))
        to_letters = lambda word: word.encode("utf-8", "surrogatepass").decode("latin-1").translate(letters)
        whole = proven(path) if whole is None else whole
        self.pattern = regex.compile(PATTERN)
        self.words = _Known(whole, lambda word: len(model.tokenize(to_letters(word))))
        self.letters = _Known([to_letters(w) for w in whole], lambda word: len(model.tokenize(word)))
        self.count = self._count

    def _count(self, text: str) -> int:
        parts = self.marks.split(text) if self.marks else [text]
        n = len(parts) - 1
        for part in parts:
            for s in slices(part):
                if _BEYOND.search(s):
                    n += sum(map(self.letters.__getitem__, (w for w, _ in self.split(s))))
                else:
                    n += sum(map(self.words.__getitem__, self.pattern.findall(s)))
        return n


_counters: dict[str, TokenCounter] = {}


def counts(documents: DataFrame, *, text_col: str = "text", tokenizer: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """row, n_bytes (UTF-8), n_tokens of every text. ``tokenizer``: a file all executors have (null: the public byte-level BPE
    by its package)."""
    df = documents.select(row_of(documents, carry, (text_col,)), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    whole = documents.sparkSession.sparkContext.broadcast(proven(tokenizer or tokenizer_path()))

    def run(batches):
        path = tokenizer or tokenizer_path()
        if path not in _counters:
            _counters[path] = TokenCounter(path, whole.value)
        count = _counters[path].count
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("n_bytes"), pa.array([count(t) for t in b.column("text").to_pylist()], pa.int64())], names=["row", "n_bytes", "n_tokens"])

    return df.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, df.select("row").schema.add("n_bytes", "long").add("n_tokens", "long"))
