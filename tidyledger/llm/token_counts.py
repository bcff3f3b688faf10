"""Token counts under a unigram vocabulary, shared by prefix.

The distinct pre-tokens of a step are put in a trie. Level by level, for all
prefixes of one length at once, the best segmentation that ends there is found
from those of the shorter prefixes above it, so that a prefix is scored once
however many pre-tokens begin with it. At the end of a pre-token the number of
pieces of its best segmentation is stored.

Every pre-token goes into the trie as windows of WINDOW characters: one string for
each place at which a piece that reaches over the beginning of the window ends, with
the characters that a piece may reach over the end of the window. Nearly all
pre-tokens are one window. Of a longer one, the best ways through each window are
put together from left to right. Scores are whole numbers, so their sums do not
depend on where the windows begin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import arrow_map, pieces_between_spaces, slices

SPACE = "▁"  # what the vocabulary writes for a space
UNKNOWN_PENALTY = 10.0  # an unknown character scores this much below the worst piece
WINDOW = 32  # characters from the beginning of a window to that of the next
STRINGS = 1 << 16  # strings that are in a trie together
_UNIT = 1 << 32  # scores are whole numbers of 1 / _UNIT
_NONE = -(1 << 60)  # below every score
STEP = 2 << 20  # bytes of text that are looked at together
_CACHED = 200_000  # pre-tokens whose count a task remembers
_CACHED_BYTES = 48  # a longer one is not remembered
_BASE = np.uint64(0xBF58476D1CE4E5B9)
_MIX = np.uint64(0x94D049BB133111EB)


def load_pieces(path: str | None = None) -> dict[str, float]:
    """Pieces of a sentencepiece vocabulary with a score for unigram segmentation.

    The public vocabulary gives ranks instead of log probabilities; a piece of
    rank r scores -ln(r + 2), as in a Zipf distribution. Control, unknown and byte
    pieces have no place in a segmentation, nor has a piece with a space inside.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces, rank = {}, 0
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        if SPACE not in piece.lstrip(SPACE):
            pieces[piece] = -math.log(rank + 2)
        rank += 1
    return pieces


class Segmenter:
    """Number of pieces of the best segmentation; of equal scores the fewest pieces.

    A character that no piece has is as many tokens as it has UTF-8 bytes.
    """

    def __init__(self, pieces: dict[str, float]):
        self.unknown = round((min(pieces.values()) - UNKNOWN_PENALTY) * _UNIT)
        self.longest = max(map(len, pieces))
        # A window must hold the end of every piece that reaches into it.
        self.window = max(WINDOW, self.longest)
        by_length: dict[int, list[tuple[str, int]]] = {}
        for piece, score in pieces.items():
            by_length.setdefault(len(piece), []).append((piece, round(score * _UNIT)))
        self.tables = {}
        for length, some in by_length.items():
            points = np.array([p for p, _ in some], f"<U{length}").view(np.uint32).reshape(-1, length)
            keys = np.zeros(len(some), np.uint64)
            for column in points.T:
                keys = _extend(keys, column)
            order = np.argsort(keys)
            self.tables[length] = keys[order], np.array([s for _, s in some], np.int64)[order]
        self.powers = [1]
        for _ in range(self.longest):
            self.powers.append(self.powers[-1] * int(_BASE) % (1 << 64))

    def _windows(self, text: str) -> Iterator[tuple[int, np.ndarray, range]]:
        """Beginning, entries and exits (places in the text) of each window of a pre-token.

        A segmentation enters a window at its beginning, or where a piece that
        reaches over the beginning ends; no other place need be looked at.
        """
        last = max(0, -(-(len(text) - self.longest + 1) // self.window) - 1)
        begins = np.arange(last + 1) * self.window
        points = np.array([text], f"<U{len(text)}").view(np.uint32)
        entered = np.zeros((last + 1, self.longest), bool)
        entered[:, 0] = True
        for before in range(1, self.longest):
            keys = np.zeros(last, np.uint64)
            for length in range(1, self.longest + 1):
                keys = _extend(keys, points[begins[1:] - before + length - 1])
                if length > before and length in self.tables:
                    table = self.tables[length][0]
                    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                    entered[1:, length - before] |= table[place] == keys
        for k, begin in enumerate(begins.tolist()):
            following = begin + self.window
            exits = range(len(text), len(text) + 1) if k == last else range(following, following + self.longest)
            yield begin, begin + np.flatnonzero(entered[k]), exits

    def many(self, texts: list[str]) -> np.ndarray:
        """Counts for distinct pre-tokens."""
        result = np.zeros(len(texts), np.int64)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        of_one = lengths < self.window + self.longest
        whole = np.flatnonzero(of_one & (lengths > 0))
        windows = [(i, *w) for i in np.flatnonzero(~of_one).tolist() for w in self._windows(texts[i])]
        reached: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        per_trie = STRINGS // self.longest
        for at in range(0, max(len(windows), 1), per_trie):
            group = windows[at : at + per_trie]
            alone = whole if at == 0 else whole[:0]
            strings = [texts[i] for i in alone.tolist()]
            owner, depth = [np.arange(len(alone))], [lengths[alone]]
            for i, _, entries, exits in group:
                owner.append(np.repeat(len(strings) + np.arange(len(entries)), len(exits)))
                depth.append((np.array(exits)[None, :] - entries[:, None]).ravel())
                strings += [texts[i][start : exits[-1]] for start in entries.tolist()]
            score, count = self._forward(strings, np.concatenate(owner), np.concatenate(depth))
            result[alone] = count[: len(alone)]
            place = len(alone)
            for i, begin, entries, exits in group:
                size = len(entries) * len(exits)
                ways = score[place : place + size].reshape(len(entries), -1)
                tokens = count[place : place + size].reshape(len(entries), -1)
                if begin:
                    ways = ways + reached[i][0][entries - begin, None]
                    tokens = tokens + reached[i][1][entries - begin, None]
                best = ways.max(axis=0)
                fewest = np.where(ways == best, tokens, np.iinfo(np.int64).max).min(axis=0)
                reached[i], result[i] = (best, fewest), fewest[-1]
                place += size
        return result

    def _forward(self, strings: list[str], owner: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best score and number of pieces of the first `depths` characters of the strings `owner`."""
        scores, counts = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
        if not len(owner):
            return scores, counts
        order = np.argsort(depths, kind="stable")
        width = int(depths.max())
        points = np.array(strings, f"<U{width}").view(np.uint32).reshape(-1, width)
        ends = np.fromiter(map(len, strings), np.int64, len(strings))
        asked = np.searchsorted(depths[order], np.arange(1, width + 2))
        # Level 0 is the root. Of each level: hash, best score, count, and the node above.
        node = np.zeros(len(strings), np.int64)
        keys, best, count, above = [np.zeros(1, np.uint64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [None]
        alive = np.arange(len(strings))
        for depth in range(1, width + 1):
            alive = alive[ends[alive] >= depth]
            step = (node[alive] << 21) | points[alive, depth - 1].astype(np.int64)
            distinct, at = np.unique(step, return_inverse=True)
            node[alive] = at
            parent, last = distinct >> 21, (distinct & 0x1FFFFF).astype(np.uint32)
            keys.append(_extend(keys[-1][parent], last))
            above.append(parent)
            self._score_level(keys, best, count, above, last)
            here = order[asked[depth - 1] : asked[depth]]
            scores[here], counts[here] = best[-1][node[owner[here]]], count[-1][node[owner[here]]]
        return scores, counts

    def _score_level(self, keys, best, count, above, last: np.ndarray) -> None:
        depth = len(keys) - 1
        top = np.full(len(last), _NONE)
        tokens = np.zeros(len(last), np.int64)
        node = np.arange(len(last))
        for length in range(1, min(depth, self.longest) + 1):
            node = above[depth - length + 1][node]
            score = np.full(len(last), _NONE)
            added = np.ones(len(last), np.int64)
            if length in self.tables:
                table, scores = self.tables[length]
                key = keys[depth] - keys[depth - length][node] * np.uint64(self.powers[length])
                place = np.minimum(np.searchsorted(table, key), len(table) - 1)
                known = table[place] == key
                score[known] = scores[place[known]]
            if length == 1:
                unknown = score == _NONE
                score[unknown] = self.unknown
                added[unknown] = _utf8_length(last[unknown])
            found, n = best[depth - length][node] + score, count[depth - length][node] + added
            better = (found > top) | ((found == top) & (n < tokens))
            top, tokens = np.where(better, found, top), np.where(better, n, tokens)
        best.append(top)
        count.append(tokens)


def _extend(keys: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hashes of strings with one more character."""
    x = (points.astype(np.uint64) + np.uint64(1)) * _MIX
    return keys * _BASE + (x ^ (x >> np.uint64(29)))


def _utf8_length(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


class Counter:
    """Counts for batches of texts; remembers a bounded number of pre-tokens."""

    def __init__(self, pieces: dict[str, float]):
        self.segmenter = Segmenter(pieces)
        self.known: dict[bytes, int] = {}

    def count(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of each text."""
        pieces, first = pieces_between_spaces(array)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        place = coded.indices.to_numpy().astype(np.int64)
        # The first pre-token of a text begins with a space of its own.
        some = np.flatnonzero(np.diff(first))
        heads = [b" " + distinct[i] for i in place[first[some]].tolist()]
        place[first[some]] = len(distinct) + np.arange(len(heads))
        distinct += heads
        if len(self.known) > _CACHED:
            self.known = {}
        new = list(dict.fromkeys(p for p in distinct if p not in self.known))
        found = dict(zip(new, self.segmenter.many([p.decode().replace(" ", SPACE) for p in new]).tolist()))
        tokens = np.fromiter(
            (found[p] if p in found else self.known[p] for p in distinct), np.int64, len(distinct)
        )
        self.known.update((p, n) for p, n in found.items() if len(p) <= _CACHED_BYTES)
        total = np.concatenate([[0], np.cumsum(tokens[place])])
        return np.diff(first), total[first[1:]] - total[first[:-1]]


def token_counts(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """The id, `n_chars`, `n_pretokens` and `n_tokens` of every row.

    A pre-token is a run of text up to the next single space between two visible
    characters; the space belongs to the pre-token after it, and the first of a
    text gets one. Null and empty texts have no tokens. Repeated rows stay rows;
    an empty table gives none.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in slices(batches, "_text", STEP):
            counter = counter or Counter(load_pieces(vocabulary))
            pretokens, tokens = counter.count(batch.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_n"), pa.array(pretokens), pa.array(tokens)],
                ["_id", "n_chars", "n_pretokens", "n_tokens"],
            )

    kind = df.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = df.select(F.col(id_column).alias("_id"), F.length(text).cast("long").alias("_n"), text.alias("_text"))
    schema = f"_id {kind}, n_chars long, n_pretokens long, n_tokens long"
    return arrow_map(rows, compute, schema).withColumnRenamed("_id", id_column)
