"""Token counts that follow edits: a segment tree over each document's pre-tokens.

A text is cut into pre-tokens by the vocabulary's pattern; byte-level BPE never joins two of them, so
a text's token count is the sum over its pre-tokens. A leaf of the tree holds the characters and
tokens of about ``LEAF`` pre-tokens, an inner node the sums of its two children, the root the
document's count. An edit replaces the characters start..end (code points) by a string. Re-encoding
begins at the last leaf that starts at least two characters before the edit (a pre-token depends on
at most two characters after it), and ends at the first leaf after the edit whose start the new
pre-tokens meet again; only the leaves between and their ancestors change.

Vocabulary: a ``.tiktoken`` rank file, read on the driver from a path parameter and broadcast (its
size is checked against ``VOCABULARY_BYTES``). Null and empty texts have 0 tokens; edits must be
sorted and must not overlap; each row is its own document, so repeated rows and ids are no matter;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from driftsweep.llm.common import ready

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_BYTES = 16 << 20
LEAF = 64
CONTEXT = 2
CACHE = 200_000
#: Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Edit = tuple[int, int, str]


class Counter(dict):
    """Tokens of a pre-token; keeps at most CACHE of them."""

    def __init__(self, ranks: bytes) -> None:
        super().__init__()
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={},
                                          mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs})
        self.pattern = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


class Tree:
    """Sums of characters and tokens over the leaves of one text, in heap order (root at 1)."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves = len(chars)
        self.size = 1 << max(0, (max(1, self.leaves) - 1).bit_length())
        self.sums = np.zeros((2, 2 * self.size), np.int64)
        self.sums[0, self.size:self.size + self.leaves] = chars
        self.sums[1, self.size:self.size + self.leaves] = tokens
        at = self.size
        while at > 1:
            at //= 2
            self.sums[:, at:2 * at] = self.sums[:, 2 * at:4 * at:2] + self.sums[:, 2 * at + 1:4 * at:2]

    @classmethod
    def of(cls, text: str, counter: Counter) -> tuple[Tree, int]:
        pieces = counter.pattern.findall(text)
        n = len(pieces)
        if not n:
            return cls(np.zeros(0, np.int64), np.zeros(0, np.int64)), 0
        chars = np.fromiter(map(len, pieces), np.int64, n)
        tokens = np.fromiter(map(counter.__getitem__, pieces), np.int64, n)
        at = np.arange(0, n, LEAF)
        return cls(np.add.reduceat(chars, at), np.add.reduceat(tokens, at)), n

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character position (or the last) and where it starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if position - start >= self.sums[0, node]:
                start += int(self.sums[0, node])
                node += 1
        leaf = node - self.size
        if leaf >= self.leaves:  # behind the last character
            leaf = max(0, self.leaves - 1)
            start = int(self.sums[0, 1] - self.sums[0, self.size + leaf])
        return leaf, start

    def put(self, first: int, stop: int, chars: list[int], tokens: list[int]) -> None:
        """Give the leaves first..stop the new sums (as many, zeros at the end) and renew their ancestors."""
        a, b = self.size + first, self.size + stop
        self.sums[0, a:b], self.sums[1, a:b] = chars, tokens
        b -= 1
        while a > 1:
            a, b = a // 2, b // 2
            self.sums[:, a:b + 1] = self.sums[:, 2 * a:2 * b + 2:2] + self.sums[:, 2 * a + 1:2 * b + 2:2]


def apply_edits(text: str, tree: Tree, edits: list[Edit], counter: Counter) -> tuple[str, int]:
    """The edited text, and the pre-tokens that were encoded anew; ``tree`` then holds the new counts.

    Leaf starts are looked up in the old tree, whose sums are renewed after the last edit.
    """
    parts, at = [], 0
    for start, end, new in edits:
        parts += [text[at:start], new]
        at = end
    parts.append(text[at:])
    edited = "".join(parts)
    if not tree.leaves:
        fresh, n = Tree.of(edited, counter)
        tree.__dict__.update(fresh.__dict__)
        return edited, n
    renewed, done, shift, i = [], 0, 0, 0
    while i < len(edits):
        begin, meet = tree.leaf_at(max(0, edits[i][0] - CONTEXT))
        pos, stop, last_end = meet + shift, begin, 0
        lens, counts = [], []
        while True:
            # ``meet``: start of leaf ``stop`` in the old text, behind all edits that can change what lies before it
            while i < len(edits) and edits[i][0] < meet + CONTEXT or stop == begin or meet < last_end or meet + shift < pos:
                if i < len(edits) and (edits[i][0] < meet + CONTEXT or stop == begin and not last_end):
                    shift += len(edits[i][2]) - (edits[i][1] - edits[i][0])
                    last_end = edits[i][1]
                    i += 1
                else:
                    meet += int(tree.sums[0, tree.size + stop])
                    stop += 1
            if pos == meet + shift:
                break
            m = counter.pattern.match(edited, pos)
            lens.append(m.end() - pos)
            counts.append(counter[m.group()])
            pos = m.end()
        done += len(lens)
        each = max(1, -(-len(lens) // (stop - begin)))
        chars = [sum(lens[k:k + each]) for k in range(0, len(lens), each)]
        tokens = [sum(counts[k:k + each]) for k in range(0, len(counts), each)]
        spare = [0] * (stop - begin - len(chars))
        renewed.append((begin, stop, chars + spare, tokens + spare))
    for begin, stop, chars, tokens in renewed:
        tree.put(begin, stop, chars, tokens)
    return edited, done


#: The edits of the query: personal data and secrets give way to marks.
_MARKS = re.compile(r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
                    r"|(?P<secret>\b[0-9a-f]{40}\b)|(?P<number>\b[0-9]{12,19}\b)")
_HAS_DIGITS = re.compile(r"[0-9]{12}|[0-9a-f]{40}")


def redactions(text: str) -> list[Edit]:
    """Edits that mask e-mail addresses, long numbers and 40-digit hexadecimal secrets."""
    if "@" not in text and not _HAS_DIGITS.search(text):
        return []
    return [(m.start(), m.end(), f"<{m.lastgroup}>") for m in _MARKS.finditer(text)]


def read_ranks(path: str = VOCABULARY) -> bytes:
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary that may be broadcast")
    with open(path, "rb") as f:
        return f.read()


def count_edited(docs: DataFrame, propose: Callable[[str], list[Edit]] = redactions, vocabulary: str = VOCABULARY) -> DataFrame:
    """Counts of every row of docs (doc_id, text) before and after the edits that ``propose`` gives.

    doc_id, n_pretokens, n_tokens (before), n_edits, n_reencoded (pre-tokens encoded anew), n_tokens_after.
    """
    spark = ready(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks.value)
        for b in batches:
            out = []
            for cell in b.column("text"):
                text = cell.as_py() or ""
                tree, pieces = Tree.of(text, counter)
                before, edits = tree.tokens, propose(text)
                again = apply_edits(text, tree, edits, counter)[1] if edits else 0
                out.append((pieces, before, len(edits), again, tree.tokens))
            names = ("n_pretokens", "n_tokens", "n_edits", "n_reencoded", "n_tokens_after")
            yield pa.record_batch({"doc_id": b.column("doc_id")}
                                  | {n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(names)})
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_pretokens long, n_tokens long, n_edits long, n_reencoded long, n_tokens_after long")
