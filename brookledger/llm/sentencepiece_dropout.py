"""SentencePiece encoding with seeded merge-dropout, and lossless decoding."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.llm.batches import Hasher, Texts, byte_table, column, mix, slices, small_batches
from brookledger.llm.word_cache import Numbers, WordCache, ragged
from brookledger.llm.worker_memory import remembered_by, turn_of

SEED = 5
DROPOUT = 0.1
#: Longest word, in characters, whose segmentations are remembered.
SHORT = 16
#: Missing segmentations that are made at once.
AT_ONCE = 50_000
#: Fixed value: how the vocabulary writes a blank.
BLANK = "▁"


#: Gets candidates as arrays (number of the word, start, end).
Candidates = Callable[[np.ndarray, np.ndarray, np.ndarray], "np.ndarray | None"]
#: Symbols one after the other, where each word begins in them, and its number of them.
Spelled = tuple[np.ndarray, np.ndarray, np.ndarray]


def dropped(draws: np.ndarray, start: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether candidates are dropped: by the hash of the occurrence's draw and the two ends."""
    if not dropout:
        return np.zeros(len(draws), bool)
    with np.errstate(over="ignore"):
        h = mix(draws ^ (start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + end.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < dropout


class PairTable:
    """A number for each of many pairs of numbers."""

    def __init__(self, pairs: np.ndarray, values: np.ndarray):
        self.numbers, self.values = Numbers(), np.append(values, -1).astype(np.int32)
        self.numbers.add(self._keys(pairs[:, 0], pairs[:, 1]))

    def _keys(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return ((left.astype(np.int64) << 32) | right).view(np.uint64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The numbers of pairs, -1 for a pair that is not there."""
        return self.values[self.numbers.get(self._keys(left, right))]


class Pieces:
    """A vocabulary: merges for encoding, bytes for decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids: dict[str, int] = {}
        score: list[float] = []
        self.byte = [0] * 256
        content: list[bytes] = []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            score.append(model.get_score(k))
            if model.is_byte(k):
                self.byte[int(piece[3:5], 16)] = k
                content.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(k) or model.is_unknown(k):
                content.append(b"")
            else:
                ids[piece] = k
                content.append(piece.replace(BLANK, " ").encode())
        if any(BLANK in p.lstrip(BLANK) for p in ids):
            raise ValueError("a piece reaches across words: words cannot be encoded one by one")
        merged = {c for p in ids if len(p) > 1 for c in p}
        #: Control characters that no merge takes in.
        self.cuts = byte_table(k for k in range(0x20) if chr(k) not in merged)
        self.lengths = np.array([len(c) for c in content], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(content), np.uint8)
        #: The piece of each character; -1 where it has none, and for the character that stands for a blank.
        self.piece_of = np.full(0x110000, -1, np.int32)
        for piece, k in ids.items():
            if len(piece) == 1 and piece != BLANK:
                self.piece_of[ord(piece)] = k
        self.piece_of[0x20] = ids[BLANK]
        pairs = {(ids[p[:n]], ids[p[n:]]): k for p, k in ids.items() for n in range(1, len(p)) if p[:n] in ids and p[n:] in ids}
        self.merges = PairTable(np.array(list(pairs), np.int64).reshape(-1, 2), np.array(list(pairs.values()), np.int64))
        #: By piece; the last for no piece.
        self.score = np.array([*score, -np.inf], np.float32)
        self.cache = WordCache()
        self.hasher = Hasher(55)
        #: A number for each candidate of a short word, by start * (SHORT + 1) + end.
        self.marks = mix(mix(np.arange(1, (SHORT + 1) ** 2 + 1, dtype=np.uint64)) + np.uint64(77))

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """The pieces of characters; one without a piece keeps its code, as a number below -1."""
        pieces = self.piece_of[points]
        return np.where(pieces < 0, -2 - points.astype(np.int32), pieces)

    def _merge(self, symbols: np.ndarray, skipped: Candidates | None, merges: Candidates | None) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all words one after the other, number of each), from rows of symbols that end in at least one -1.

        Each row has an agenda of candidates. In each round every word with a
        candidate left takes its best one, the leftmost of equal scores, and the
        merged symbol proposes itself to its two neighbours. ``skipped`` says
        which candidates (row, start, end) are dropped, ``merges`` is told of
        those that merge, at most one of a row in each call.
        """
        n, width = symbols.shape
        symbols = symbols.ravel()
        # Places count through all rows; beyond a row's ends there is no symbol to meet.
        end, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
        score, piece = np.full(len(symbols), -np.inf, np.float32), np.full(len(symbols), -1, np.int32)
        by_row = score.reshape(n, width)

        def propose(left: np.ndarray) -> None:
            right = end[left]
            merged = self.merges.get(symbols[left], symbols[right])
            worth = self.score[merged]
            if skipped is not None:
                found = np.flatnonzero(merged >= 0)
                row, start = np.divmod(left[found], width)
                worth[found[skipped(row, start, end[right[found]] - row * width)]] = -np.inf
            score[left], piece[left] = worth, merged

        propose(np.flatnonzero(symbols >= 0))
        rows = np.arange(n)
        while len(rows):
            start = (by_row if len(rows) == n else by_row[rows]).argmax(axis=1)
            left = rows * width + start
            going = score[left] > -np.inf
            if not going.all():
                rows, start, left = rows[going], start[going], left[going]
            right = end[left]
            after = end[right]
            symbols[left], symbols[right] = piece[left], -1
            score[right] = -np.inf
            end[left], before[after] = after, left
            if merges is not None:
                merges(rows, start, after - rows * width)
            propose(np.concatenate([left, before[left[start > 0]]]))
        alive = symbols != -1
        return symbols[alive], alive.reshape(n, width).sum(axis=1)

    def segments(self, spelled: Spelled, skipped: Candidates | None, merges: Candidates | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each). Blanks in words are plain spaces.

        ``skipped`` and ``merges`` get candidates as (index of the word, start, end).
        Characters without a piece become bytes; so does the character that
        stands for a blank, so that it is not mistaken for one.
        """
        symbols, starts, sizes = spelled
        lengths, parts = np.zeros(len(sizes), np.int64), []
        # Words of like length together, so that little is padded.
        widths = 1 << np.ceil(np.log2(np.maximum(sizes, 4))).astype(np.int64)
        for width in np.unique(widths).tolist():
            rows_at_once = max(1, 1_000_000 // width)
            members = np.flatnonzero(widths == width)
            for low in range(0, len(members), rows_at_once):
                own = members[low : low + rows_at_once]
                padded = np.full((len(own), width + 1), -1, np.int32)
                within = ragged(np.zeros(len(own), np.int64), sizes[own])
                padded.ravel()[np.repeat(np.arange(len(own)) * (width + 1), sizes[own]) + within] = symbols[np.repeat(starts[own], sizes[own]) + within]
                merged, count = self._merge(
                    padded, skipped and (lambda row, *ends: skipped(own[row], *ends)), merges and (lambda row, *ends: merges(own[row], *ends)))
                unknown = np.flatnonzero(merged < 0)
                if len(unknown):
                    spelled = [[self.byte[x] for x in chr(-2 - c).encode()] for c in merged[unknown].tolist()]
                    extra = np.array([len(x) for x in spelled])
                    word = np.repeat(np.arange(len(own)), count)
                    repeats = np.ones(len(merged), np.int64)
                    repeats[unknown] = extra
                    merged = np.repeat(merged, repeats)
                    merged[merged < 0] = [x for b in spelled for x in b]
                    count = np.bincount(word, repeats, len(own)).astype(np.int64)
                lengths[own] = count
                parts.append((own, merged))
        out = np.zeros(int(lengths.sum()), np.uint32)
        places = np.cumsum(lengths) - lengths
        for own, merged in parts:
            out[ragged(places[own], lengths[own])] = merged
        return out, lengths

    def _remembered(self, names: np.ndarray, draws: np.ndarray, dropout: float, spelled: Spelled) -> list[tuple]:
        """Parts (words, ids of all of them one after the other, number of ids of each) that cover all short words.

        names: a number for each word; draws: one for each occurrence. What
        comes out depends only on which candidates merge: one that is dropped
        but would not have merged makes no difference. So segmentations are
        remembered by word and dropped candidates, with those that merged on
        the way: an occurrence whose own draw drops none of these has its
        answer, any other goes on to the segmentation without them.
        """
        at, node, parts = np.arange(len(names)), names, []
        gone_at, gone = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        while len(at):

            def make(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                made = [self._made(at[which[k : k + AT_ONCE]], gone_at, gone, spelled) for k in range(0, len(which), AT_ONCE)]
                return np.concatenate([r for r, _ in made]), np.concatenate([n for _, n in made])

            runs, heads, sizes = self.cache.places(node, make)
            n_ids = runs[heads].astype(np.int64)
            n_done = sizes - 1 - n_ids
            done = runs[ragged(heads + 1 + n_ids, n_done)]
            owner = np.repeat(np.arange(len(at)), n_done)
            start, end = np.divmod(done, np.uint32(SHORT + 1))
            drop = np.flatnonzero(dropped(draws[at[owner]], start, end, dropout))
            owner, done = owner[drop], done[drop]
            settled = np.ones(len(at), bool)
            settled[owner] = False
            parts.append((at[settled], runs[ragged(heads[settled] + 1, n_ids[settled])], n_ids[settled]))
            if not len(owner):
                break
            gone_at, gone = np.concatenate([gone_at, at[owner]]), np.concatenate([gone, done])
            firsts = np.flatnonzero(np.diff(owner, prepend=-1))
            with np.errstate(over="ignore"):
                node = node[~settled] + np.add.reduceat(self.marks[done], firsts)
            at = at[~settled]
        return parts

    def _made(self, words: np.ndarray, gone_at: np.ndarray, gone: np.ndarray, spelled: Spelled) -> tuple[np.ndarray, np.ndarray]:
        """A run for each word without its dropped candidates: number of ids, ids, the candidates that merged; and its length."""
        symbols, starts, sizes = spelled
        skipped = None
        if len(gone):
            row_of = np.full(len(sizes), -1, np.int64)
            row_of[words] = np.arange(len(words))
            out, codes = np.zeros(len(words) * (SHORT + 1) ** 2, bool), (SHORT + 1) ** 2
            row = row_of[gone_at]
            out[(row * codes + gone)[row >= 0]] = True

            def skipped(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
                return out[row * codes + start * (SHORT + 1) + end]

        done, n_done = np.zeros((len(words), SHORT), np.uint32), np.zeros(len(words), np.int64)

        def merges(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
            done[row, n_done[row]] = start * (SHORT + 1) + end
            n_done[row] += 1

        ids, n_ids = self.segments((symbols, starts[words], sizes[words]), skipped, merges)
        lengths = 1 + n_ids + n_done
        heads = np.cumsum(lengths) - lengths
        runs = np.zeros(int(lengths.sum()), np.uint32)
        runs[heads] = n_ids
        runs[ragged(heads + 1, n_ids)] = ids
        runs[ragged(heads + 1 + n_ids, n_done)] = done[np.arange(SHORT) < n_done[:, None]]
        return runs, lengths

    def encode(self, texts: pa.Array, keys: np.ndarray, seed: int, dropout: float, copies: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text).

        keys and copies: numbers for each text (or one for all) that its draws
        depend on, besides the seed; each word draws for its place in the text.
        A blank is put before a text that is not empty, as the vocabulary expects.
        """
        seen = Texts(texts)
        text, bounds = seen.text, seen.bounds
        # Words: blanks and what follows them; characters that no merge takes in are words.
        space, control = text == 0x20, self.cuts[text]
        start = np.zeros(len(text) + 1, bool)
        start[1:-1] = (space[1:] & ~space[:-1]) | control[:-1]
        start[:-1] |= control
        start[bounds[:-1]] = True
        starts = np.flatnonzero(start[:-1])
        lengths = np.diff(np.append(starts, len(text)))
        first = np.searchsorted(starts, bounds)
        counts = np.diff(first)
        owner = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(starts)) - first[:-1][owner]
        copies = np.broadcast_to(np.asarray(copies, np.int64), len(counts)).astype(np.uint64)
        leads = place == 0  # these get the blank
        with np.errstate(over="ignore"):
            of_text = mix(mix(keys.astype(np.int64).view(np.uint64) + np.uint64(seed)) + copies * np.uint64(0xD1B54A32D192ED03))
            draws = mix(of_text[owner] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            names = mix(self.hasher.words(text, starts, lengths) + leads * np.uint64(0x5851F42D4C957F2D))
        # The characters, with a blank before each text that is not empty.
        points = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
        filled = np.cumsum(counts > 0)
        symbols = self.symbols(np.insert(np.frombuffer(text.tobytes().decode().encode("utf-32-le"), np.uint32), points[bounds[:-1][counts > 0]], 0x20))
        chars = points[starts + lengths] - points[starts] + leads
        where = points[starts] + filled[owner] - leads
        is_short = chars <= SHORT
        short, long = np.flatnonzero(is_short), np.flatnonzero(~is_short)
        parts = [
            (short[own], ids, n)
            for own, ids, n in self._remembered(names[short], draws[short], dropout, (symbols, where[short], chars[short]))
        ]
        if len(long):
            spelled = symbols, where[long], chars[long]
            parts.append((long, *self.segments(spelled, lambda row, *at: dropped(draws[long[row]], *at, dropout))))
        sizes = np.zeros(len(starts), np.int64)
        for own, _, n in parts:
            sizes[own] = n
        out, places = np.zeros(int(sizes.sum()), np.uint32), np.cumsum(sizes) - sizes
        for own, ids, n in parts:
            out[ragged(places[own], n)] = ids
        return out, np.diff(np.concatenate([[0], np.cumsum(sizes)])[first])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts back, by a table of the pieces' bytes; the blank in front is dropped."""
        lengths = self.lengths[ids]
        raw = self.bytes[ragged(self.starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [raw[a + 1 : b] for a, b in zip(ends, ends[1:])]


@functools.cache
def _pieces(path: str) -> Pieces:
    """What is remembered holds for any seed and dropout."""
    return Pieces(path)


remembered_by("sentencepiece", _pieces)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


SCHEMA = "doc_id long, n_tokens long, ids array<int>, lossless boolean"


def encoded(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
    seed: int = SEED, dropout: float = DROPOUT, copy: str | None = None, position: str | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids, whether they decode to the text, and the column ``position`` (if one is named).

    The whole text is encoded; null and empty texts have no ids. The same seed,
    id, text and number in the column ``copy`` (if there is one) give the same
    ids, in any order of the rows; a null id or number draws like 0. Dropout 0
    gives the ids of the library. Repeated rows are repeated, other columns are
    ignored. By row, without a shuffle.
    """
    small_batches(docs.sparkSession)
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_of("sentencepiece")
        pieces = _pieces(path)
        for part, texts in slices(batches):
            keys, copies = (column(part, c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("doc_id", "copy"))
            ids, counts = pieces.encode(texts, keys, seed, dropout, copies)
            back = pieces.decode(ids, counts)
            same = [t.as_buffer().to_pybytes() == b for t, b in zip(texts, back)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(counts), lists, pa.array(same, pa.bool_()), *(column(part, n) for n in placed)],
                ["doc_id", "n_tokens", "ids", "lossless", *placed],
            )

    number = F.col(copy) if copy else F.lit(0)
    placed = ["position"] if position else []
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), number.cast("long").alias("copy"),
        *([F.col(position).cast("long").alias("position")] if position else []))
    return rows.mapInArrow(run, SCHEMA + (", position long" if position else ""))
