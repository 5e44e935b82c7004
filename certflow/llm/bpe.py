"""BPE encoding and decoding of whole texts; long texts by tree concatenation."""

from __future__ import annotations

import json
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from certflow.llm.tasks import groups, steps, stored

LEAF_CHARS = 1 << 16
# Leaves that one task encodes or joins on average, and neighbours that one step of the tree joins.
TASK_LEAVES = 16
FAN = 16
FIRST_WINDOW = 32
WORD_CACHE = 200_000
STEP_WORDS = 4096

# Runs of ASCII white space part words, which the pre-tokenizer of some files never joins (see words_apart).
_word = re.compile(r"[^\x20\x09-\x0D]+")
_white = re.compile(r"[\x20\x09-\x0D]")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file; TOKENIZER_DIR names the folder where a cluster's nodes hold them."""
    return os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), name)


def tokenizer(file: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(file)
    made.no_truncation()
    made.no_padding()
    return made


def words_apart(model) -> bool:
    """The file's rules drop ASCII white space and look at no neighbouring word, so words can be encoded one by one."""
    rules = json.loads(model.to_str())
    listed = lambda part, name: (part or {}).get(name) or ([part] if part else [])
    first = listed(rules["pre_tokenizer"], "pretokenizers")[:1]
    kind = first[0]["type"] if first else None
    if kind == "Split":
        # a pattern must not look around, and its anchors would see the ends of a word as those of the text
        pattern = "".join(first[0]["pattern"].values()).replace("[^", "")
        drops = first[0]["behavior"] == "Removed" and not re.search(r"\(\?[=!<]|\\[bBAzZG]|\^|\$", pattern)
    else:
        drops = kind in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")
    if not drops:
        return False
    for part in listed(rules["normalizer"], "normalizers"):
        spaces = part["type"] == "Replace" and part["pattern"] == {"Regex": "\\s+"} and part["content"] == " "
        if not spaces and part["type"] not in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "BertNormalizer"):
            return False
    if any(_white.search(t["content"]) for t in rules["added_tokens"]):
        return False
    # no piece may hold white space; each kind is tried between letters and between signs
    return not any(_white.search(text[a:b])
                   for w in " \t\n\v\f\r" for text in (f"a{w}b", f".{w}.", f"a{w}{w}.")
                   for _, (a, b) in model.pre_tokenizer.pre_tokenize_str(text))


class Tokens:
    """Token ids with the character spans that they come from, for a part of a text."""

    __slots__ = ("ids", "spans")

    def __init__(self, ids: list[int], spans: list[tuple[int, int]]):
        self.ids, self.spans = ids, spans


class Encoder:
    """Encodes texts as tokenizers does without added special tokens.

    Where words can be encoded one by one, those seen before come from a bounded cache; with other files, texts are encoded whole.
    """

    def __init__(self, file: str):
        self.model = tokenizer(file)
        self.apart = words_apart(self.model)
        marks = [(t.content, k) for k, t in self.model.get_added_tokens_decoder().items()
                 if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.mark = marks[0] if marks else None
        # words met since the last turn of the cache, and those of the turn before, from which used ones come back
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        if not self.apart:
            return [np.array(made.ids, np.int32) for made in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        split = [_word.findall(x) for x in texts]
        if len(self.words) > WORD_CACHE:
            self.older, self.words = self.words, {}
        new = []
        for word in set().union(*split).difference(self.words):
            if word in self.older:
                self.words[word] = self.older[word]
            else:
                new.append(word)
        self._learn(new)
        return [np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32) for words in split]

    def _learn(self, new: list[str]) -> None:
        """Encode words many at a time: parted by a special token, which cuts a text before all other rules."""
        odd = new
        if self.mark:
            text, mark = self.mark
            plain = [w for w in new if text[0] not in w and text[-1] not in w]
            odd = [w for w in new if text[0] in w or text[-1] in w]
            for k in range(0, len(plain), STEP_WORDS):
                step = plain[k:k + STEP_WORDS]
                made = np.array(self.model.encode_batch_fast([text.join(step)], add_special_tokens=False)[0].ids, np.int32)
                ends = np.flatnonzero(made == mark).tolist()
                data = made.tobytes()
                for word, a, b in zip(step, [-1, *ends], [*ends, len(made)], strict=True):
                    self.words[word] = data[4 * a + 4:4 * b]
        for k in range(0, len(odd), STEP_WORDS):
            step = odd[k:k + STEP_WORDS]
            for word, made in zip(step, self.model.encode_batch_fast(step, add_special_tokens=False)):
                self.words[word] = array("i", made.ids).tobytes()

    def part(self, text: str, start: int, end: int) -> Tokens:
        made = self.model.encode(text[start:end], add_special_tokens=False)
        return Tokens(list(made.ids), [(a + start, b + start) for a, b in made.offsets])

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids, skip_special_tokens=False)


def _clean(part: Tokens, k: int) -> bool:
    """The token covers whole characters: no neighbour shares its span."""
    a, b = part.spans[k]
    return a < b and (k == 0 or part.spans[k - 1][1] <= a) and (k + 1 == len(part.ids) or part.spans[k + 1][0] >= b)


def _agreed(one: Tokens, two: Tokens, low: int, high: int, last: bool) -> tuple[int, int] | None:
    """Places in both of a token with equal id and span inside [low, high): the last such, or the first."""
    where = {(one.ids[k], one.spans[k]): k for k in range(*_range(one, low, high)) if _clean(one, k)}
    spots = range(*_range(two, low, high))
    for k in reversed(spots) if last else spots:
        if _clean(two, k) and (two.ids[k], two.spans[k]) in where:
            return where[two.ids[k], two.spans[k]], k
    return None


def _range(part: Tokens, low: int, high: int) -> tuple[int, int]:
    return (bisect_left(part.spans, low, key=lambda s: s[0]), bisect_left(part.spans, high, key=lambda s: s[0]))


def join(encoder: Encoder, text: str, left: Tokens, right: Tokens, low: int, seam: int, high: int) -> Tokens:
    """Tokens of text[low:high] from those of its parts before and after `seam`.

    A window around the seam is encoded and doubled until it holds one token of the left part
    and one of the right part with the same id and span. A row of tokens of which all
    neighbours belong together is the only encoding of its text, so left tokens up to the
    first, window tokens between and right tokens from the second are exact. A window that
    reaches an end of the text takes that side over whole.
    """
    width = FIRST_WINDOW
    while True:
        a, b = max(low, seam - width), min(high, seam + width)
        window = encoder.part(text, a, b)
        before = (0, 0) if a == low else _agreed(left, window, a + 1, seam, False)
        after = (len(right.ids), len(window.ids)) if b == high else _agreed(right, window, seam, b - 1, True)
        if before and after and before[1] <= after[1]:
            (i, k), (j, m) = before, after
            return Tokens(left.ids[:i] + window.ids[k:m] + right.ids[j:], left.spans[:i] + window.spans[k:m] + right.spans[j:])
        width *= 2


def tree(encoder: Encoder, text: str, leaves: list[Tokens], cuts: list[int]) -> Tokens:
    """Join leaves pairwise, level by level; leaf k holds text[cuts[k]:cuts[k + 1]]."""
    while len(leaves) > 1:
        joined, kept = [], [cuts[0]]
        for k in range(0, len(leaves), 2):
            if k + 1 < len(leaves):
                joined.append(join(encoder, text, leaves[k], leaves[k + 1], cuts[k], cuts[k + 1], cuts[k + 2]))
            else:
                joined.append(leaves[k])
            kept.append(cuts[min(k + 2, len(leaves))])
        leaves, cuts = joined, kept
    return leaves[0] if leaves else Tokens([], [])


def encode_texts(
    docs: DataFrame, file: str, doc_id: str = "doc_id", text: str = "text", *, leaf_chars: int = LEAF_CHARS,
    decoded: bool = False,
) -> DataFrame:
    """Token ids of each whole text: columns doc_id, ids (array of int) and, if asked for, decoded.

    Texts up to leaf_chars code points are encoded where they lie. Longer ones are cut into
    leaves of that size, which are stored, dealt over tasks by their number and encoded there. A text's
    nodes are then joined as a tree, in rounds of up to 16 neighbours, each in a task of its own, with windows
    around each join (see `join`). A text and its tokens must fit in a task, as they are one row.
    `file` is the path of a tokenizers JSON file that every executor can read; it is opened once a
    task. Where its rules don't part words at white space, each text is encoded whole by one call.

    Null and empty texts have no ids. Rows are kept one for one, also repeated ones and such
    with a null doc_id; extra columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    long = F.char_length("text") > leaf_chars if words_apart(tokenizer(file)) else F.lit(False)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file)
        for step in steps(batches):
            ids = encoder.ids(step.column("text").to_pylist())
            yield finished(step.column("doc_id"), ids, encoder)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, one, whole in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                parts = [whole[k:k + leaf_chars] for k in range(0, len(whole), leaf_chars)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * len(parts), pa.int64()), pa.array([one] * len(parts), batch.column("doc_id").type),
                    pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())], ["row", "doc_id", "leaf", "text"])

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file)
        for batch in batches:
            for k, part in enumerate(batch.column("text").to_pylist()):
                made = encoder.part(part, 0, len(part))
                yield pa.RecordBatch.from_arrays([
                    *batch.slice(k, 1).columns, pa.array([made.ids], pa.list_(pa.int32())),
                    pa.array([[a for a, _ in made.spans]], pa.list_(pa.int32())),
                    pa.array([[b for _, b in made.spans]], pa.list_(pa.int32()))], node_names)

    def join_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file)
        for rows in groups(batches, "row", "joined"):
            cuts, nodes = [0], []
            for r in rows:
                nodes.append(Tokens(r["ids"], [(a + cuts[-1], b + cuts[-1]) for a, b in zip(r["starts"], r["ends"])]))
                cuts.append(cuts[-1] + len(r["text"]))
            text = "".join(r["text"] for r in rows)
            made = tree(encoder, text, nodes, cuts)
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[0]["row"]], pa.int64()), pa.array([rows[0]["doc_id"]], id_type), pa.array([rows[0]["joined"]], pa.int32()),
                pa.array([text], pa.string()), pa.array([made.ids], pa.list_(pa.int32())),
                pa.array([[a for a, _ in made.spans]], pa.list_(pa.int32())),
                pa.array([[b for _, b in made.spans]], pa.list_(pa.int32()))], node_names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file)
        for step in steps(batches, 1):
            yield finished(step.column("doc_id"), [np.array(step.column("ids")[0].as_py(), np.int32)], encoder)

    def finished(keys: pa.Array, ids: list[np.ndarray], encoder: Encoder) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        columns = [keys, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))]
        names = ["doc_id", "ids"]
        if decoded:
            columns.append(pa.array([encoder.decode(x.tolist()) for x in ids], pa.string()))
            names.append("decoded")
        return pa.RecordBatch.from_arrays(columns, names)

    node_names = ["row", "doc_id", "leaf", "text", "ids", "starts", "ends"]
    id_type = to_arrow_type(source.schema["doc_id"].dataType)
    result = f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded
    short = source.where(~long).mapInArrow(encode, result)
    leaf = f"row long, doc_id {kind}, leaf int, text string"
    node = f"{leaf}, ids array<int>, starts array<int>, ends array<int>"
    leaves = stored(source.where(long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(cut, leaf), "text-leaves")
    size = leaves.agg(F.count("*").alias("leaves"), F.max("leaf").alias("last")).first()
    if not size["leaves"]:
        return short
    # numbers, as Spark would put a few rows with much work each into one task
    tasks = -(-size["leaves"] // TASK_LEAVES)
    nodes = leaves.repartition(tasks, "row", "leaf").mapInArrow(encode_leaves, node)
    width = size["last"] + 1
    while width > 1:
        width = -(-width // FAN)
        nodes = (nodes.withColumn("joined", F.floor(F.col("leaf") / FAN).cast("int")).repartition(tasks, "row", "joined")
                 .sortWithinPartitions("row", "joined", "leaf").mapInArrow(join_nodes, node))
    return short.union(nodes.mapInArrow(finish, result))


def decode_ids(encoded: DataFrame, file: str) -> DataFrame:
    """Decoded text of each row of encode_texts(), special tokens kept: columns doc_id, ids, decoded.

    The decoder of this kind of file joins tokens with a space, so no white space or case comes back.
    """
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(file)
        for step in steps(batches):
            texts = [model.decode(x or [], skip_special_tokens=False) for x in step.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*step.columns, pa.array(texts, pa.string())], [*step.schema.names, "decoded"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decode, f"{kinds}, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
