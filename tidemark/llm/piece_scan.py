"""SentencePiece (BPE) encoding and decoding by a max-plus parallel scan.

A segmentation into pieces is the one that merging by score gives exactly when every two neighbouring
pieces alone would merge back into just those two. Encoding is thus a best path over pieces whose
steps weigh 0 for such a pair and minus infinity for any other; one path of weight 0 exists.

A long document is cut into chunks of a fixed number of characters, wherever that falls. A piece may
lie across a cut: the state of a cut is the piece that ends at or behind it, given by how far it
reaches to either side. Each chunk yields the transfer matrix between the states of its two cuts
(sparse: the pairs of weight 0). The matrices of a document combine associatively in the max-plus
semiring, neighbours in rounds like a tree; then the states of the cuts go down the tree, and each chunk
is traced back by itself between its two states. Documents of one chunk need no shuffle.

No piece has the space mark after another character, so a stretch of marks and what follows it up to
the next mark is encoded by itself. It is cut further between characters that no pieces join (letters and
the full stop behind them, say): these words come again more often, and each is encoded once for all its
occurrences.

Text is taken as it is (the given model has no character map): a mark is put in front and spaces
become marks; characters without a piece become byte pieces. Decoding undoes this; a text that holds
the mark character itself comes back with spaces there, as with the reference library.

Defined cases: a null text has null ids; an empty text has none; a null id is kept; rows that repeat
are encoded each; an empty table gives an empty result; extra columns are kept, but for ones with the
names of the results, which are replaced.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import for_python, pieces, staged
from tidemark.llm.piece_batch import LONGEST, WordPaths

MARK = "▁"
CHUNK = 16_384  # characters
SEGMENT = 4  # matrices that are combined in one go
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")  # before it is cut between groups of characters
_CACHE_SIZE = 100_000
_SLICE = 2 << 20  # bytes of text whose words are held at a time

State = tuple[int, int]  # characters of the piece before and behind a cut; (0, 0) at the start


@dataclass
class Pieces:
    """A model's pieces: id, score and longest length; byte pieces by value."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    decoded: list[bytes]
    is_byte: list[bool]
    longest: int
    words: dict[str, bytes] = field(default_factory=dict, repr=False)
    pairs: dict[str, dict[str, bool]] = field(default_factory=dict, repr=False)
    heads: dict[str, str] = field(default_factory=dict, repr=False)
    spines: dict[tuple[str, int], list | None] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.suffixes = {p[i:] for p in self.ids for i in range(1, len(p))}
        self.neighbours = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.prefixes = {p[:i] for p in self.ids for i in range(1, len(p))}
        self.word = _word_pattern(self.neighbours)

        self.paths: WordPaths | None = None
        self.column: pa.Array | None = None
        self.older: dict[str, bytes] = {}
        self.name = hashlib.sha256(repr((self.ids, self.scores)).encode()).hexdigest()

    def __reduce__(self):
        return _shared, (self.name, self.ids, self.scores, self.byte_ids, self.decoded, self.is_byte,
                         self.longest)


_MODELS: dict[str, Pieces] = {}


def _shared(name: str, *fields) -> Pieces:
    """The tasks of a worker share a model, and so the words and pairs it has met."""
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = Pieces(*fields)
    return _MODELS[name]


def load_pieces(path: str) -> Pieces:
    """Pieces of a sentencepiece model file, read on the driver and sent with the tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, byte_ids, decoded, is_byte = {}, {}, [0] * 256, [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        is_byte.append(model.is_byte(i))
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            decoded.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            decoded.append(b"")
        else:
            ids[piece], scores[piece] = i, model.get_score(i)
            decoded.append(piece.replace(MARK, " ").encode())
    if any(MARK in p.lstrip(MARK) for p in ids):
        raise ValueError("pieces with the space mark inside are not supported")
    return Pieces(ids, scores, byte_ids, decoded, is_byte, max(map(len, ids), default=1))


def merge(model: Pieces, text: str, rest: int = 1) -> list[str]:
    """Merge the best-scored neighbouring pair, leftmost among equals, until none is a piece or
    ``rest`` parts are left."""
    parts = list(text)
    while len(parts) > rest:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = model.scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _spine(model: Pieces, piece: str, side: int) -> list[tuple[str, float]] | None:
    """What stands at one end (0 left, -1 right) of a piece while it is merged, from its character to
    itself, with scores. Null when scores don't fall on the way up, as then the order of merges does
    not follow from them."""
    got = model.spines.get((piece, side), "")
    if got == "":
        got = [(piece, model.scores.get(piece, 0.0))]
        if len(piece) > 1:
            below = _spine(model, merge(model, piece, 2)[side], side)
            if below is None or MARK * 2 in piece or (
                    len(below) > 1 and below[-1][1] <= got[0][1]):
                got = None
            else:
                got = below + got
        model.spines[piece, side] = got
    return got


def _apart(model: Pieces, left: str, right: str) -> bool:
    """Whether the two pieces side by side merge to just the two. While both are merged, each state
    of the left one's end meets a state of the right one's start; the two would join there if that
    pair scores better than the next step of either side (at a tie the one more to the left goes
    first)."""
    ends, starts = _spine(model, left, -1), _spine(model, right, 0)
    if ends is None or starts is None or (left[-1] == MARK and right[0] == MARK):
        return merge(model, left + right) == [left, right]
    i = j = 0
    while True:
        score = model.scores.get(ends[i][0] + starts[j][0])
        up = ends[i + 1][1] if i + 1 < len(ends) else None
        on = starts[j + 1][1] if j + 1 < len(starts) else None
        if score is not None and (up is None or score > up) and (on is None or score >= on):
            return False
        if up is None and on is None:
            return True
        if on is None or (up is not None and up >= on):
            i += 1
        else:
            j += 1


def _fits(model: Pieces, known: dict[str, bool], left: str, right: str) -> bool:
    """Weight 0: the two pieces side by side merge to just the two. ``known`` has what was found
    for this left piece."""
    got = known.get(right)
    if got is None:
        got = known[right] = _apart(model, left, right)
    return got


def _ends(model: Pieces, text: str, start: int, before: str | None, stop: int) -> dict[int, str]:
    """For every place up to ``stop`` that a path of weight 0 from ``start`` (behind the piece
    ``before``) reaches, the last piece of that path. There is one path to each place."""
    ids, prefixes, longest = model.ids, model.prefixes, model.longest
    last: dict[int, str | None] = {start: before}
    if len(model.pairs) > _CACHE_SIZE:
        model.pairs.clear()
    for place in range(start, stop):
        if place not in last:
            continue
        previous = last[place]
        known = None if previous is None else model.pairs.setdefault(previous, {})
        for end in range(place + 1, min(place + longest, stop) + 1):
            piece = text[place:end]
            whole = piece in ids or end == place + 1
            if whole and end not in last and (
                    known is None or _fits(model, known, previous, piece)):
                last[end] = piece
            if piece not in prefixes:
                break
    return last


def _trace(last: dict[int, str], start: int, end: int) -> list[str]:
    out = []
    while end > start:
        out.append(last[end])
        end -= len(last[end])
    return out[::-1]


def _to_ids(model: Pieces, parts: list[str]) -> list[int]:
    out = []
    for p in parts:
        i = model.ids.get(p)
        out.extend([i] if i is not None else [model.byte_ids[b] for b in p.encode()])
    return out


def _packed(model: Pieces, parts: list[str]) -> bytes:
    return array("i", _to_ids(model, parts)).tobytes()


def _atoms(model: Pieces, word: str) -> list[str]:
    """Parts of a word that no piece can join: cut where no piece has the two characters in a row.
    Words of letters only are left as they are."""
    if word[1:].isalpha():
        return [word]
    cuts = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in model.neighbours]
    return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]


def _encode_atom(model: Pieces, word: str) -> list[str]:
    """The best path over a word. The last piece of a beginning of a word depends on nothing behind
    it, so beginnings are kept: a new word is computed from its longest known beginning on."""
    heads, ids, suffixes, longest = model.heads, model.ids, model.suffixes, model.longest
    known = len(word)
    while known and word[:known] not in heads:
        known -= 1
    for end in range(known + 1, len(word) + 1):
        for place in range(end - 1, max(end - longest, 0) - 1, -1):
            piece = word[place:end]
            if piece in ids or place == end - 1:
                if not place:
                    heads[word[:end]] = piece
                    break
                left = heads[word[:place]]
                if _fits(model, model.pairs.setdefault(left, {}), left, piece):
                    heads[word[:end]] = piece
                    break
            if piece not in suffixes and place < end - 1:
                break
    out, end = [], len(word)
    while end:
        out.append(heads[word[:end]])
        end -= len(out[-1])
    return out[::-1]


def encode_word(model: Pieces, word: str) -> bytes:
    got = model.words.get(word)
    if got is None:
        atoms = _atoms(model, word)
        if len(atoms) > 1:
            got = b"".join([encode_word(model, x) for x in atoms])
        else:
            if len(word) > 64:  # not a word to meet again
                parts = _trace(_ends(model, word, 0, None, len(word)), 0, len(word))
            else:
                if len(model.heads) > _CACHE_SIZE:
                    model.heads.clear()
                    model.pairs.clear()
                parts = _encode_atom(model, word)
            got = _packed(model, parts)
        if len(word) <= 64:
            if len(model.words) >= 2 * _CACHE_SIZE:
                model.words.clear()
            model.words[word] = got
    return got


def _word_pattern(neighbours: set[str]) -> re.Pattern:
    """Matches the parts of a text that are encoded by themselves. Characters that pieces join, directly
    or through others, form a group; no piece has characters of two groups but for marks in front."""
    group: dict[str, set[str]] = {}
    for a, b in neighbours:
        if MARK not in (a, b) and group.setdefault(a, {a}) is not group.setdefault(b, {b}):
            less, more = sorted((group[a], group[b]), key=len)
            more |= less
            group.update(dict.fromkeys(less, more))
    runs = ["".join(map(re.escape, sorted(g))) for g in {id(g): g for g in group.values()}.values()]
    rest = f"[^{MARK}{''.join(runs)}]+"
    return re.compile("|".join([f"{MARK}*+{run}" for run in (*(f"[{r}]+" for r in runs), rest)] + [f"{MARK}+"]))


def learn(model: Pieces, words: set[str]) -> None:
    """Encode the words that are not known yet, side by side."""
    if model.paths is None:
        model.paths = WordPaths(model.ids, model.suffixes, model.longest, model.byte_ids,
                                lambda left, right: _apart(model, left, right))
    new = [w for w in words if w not in model.words]
    if len(model.words) + len(new) > _CACHE_SIZE:
        model.older, model.words, new = model.words, {}, list(words)
    if model.older:  # words that are met again stay
        kept = {w: model.older[w] for w in new if w in model.older}
        model.words.update(kept)
        new = [w for w in new if w not in kept]
    model.words.update(model.paths.encode(new))
    for word in new:
        if word not in model.words and len(word) <= LONGEST:  # longer ones are encoded where they stand
            encode_word(model, word)


def encode_words(model: Pieces, text: str) -> bytes:
    return encode_all(model, model.word.findall(text))


def encode_all(model: Pieces, words: list[str]) -> bytes:
    try:
        return b"".join(map(model.words.__getitem__, words))
    except KeyError:  # very long words are not kept
        return b"".join([encode_word(model, w) for w in words])


def normal(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def _cuts(text: str, start: int, end: int) -> tuple[int, int] | None:
    """First and last place in [start, end] where a word begins, if any."""
    low, high = max(start, 1), min(end, len(text) - 1) + 1
    first = text.find(MARK, low, high)
    while first >= 0 and text[first - 1] == MARK:
        first = text.find(MARK, first + 1, high)
    if first < 0:
        return None
    last = text.rfind(MARK, first, high)
    while text[last - 1] == MARK:
        last = text.rfind(MARK, first, last)
    return first, last


def states_at(model: Pieces, text: str, cut: int) -> list[State]:
    """Pieces that could lie at a cut: every piece of the text that ends at or behind it."""
    if cut == 0:
        return [(0, 0)]
    return [(a, o) for a in range(1, min(model.longest, cut) + 1)
            for o in range(min(model.longest - a, len(text) - cut) + 1)
            if a + o == 1 or text[cut - a:cut + o] in model.ids]


def _exits(model: Pieces, last: dict[int, str], cut: int, size: int, start: int) -> list[State]:
    out = []
    for end in range(cut, min(cut + model.longest, size) + 1):
        piece = last.get(end)
        if piece is not None and max(start, end - len(piece)) < cut:
            out.append((cut - end + len(piece), end - cut))
    return out


def transfer(model: Pieces, text: str, start: int, end: int) -> list[tuple[State, State]]:
    """The pairs of states of weight 0 between the cuts ``start`` and ``end`` of ``text``. At the end
    of a document only a piece that ends there is a state, as no text lies behind it."""
    stop = min(len(text), end + model.longest - 1)
    words = _cuts(text, start, end - 1)  # no piece lies across the beginning of a word
    out = []
    tail = _exits(model, _ends(model, text, words[1], None, stop), end, len(text), words[1]
                  ) if words else []
    for a, o in states_at(model, text, start):
        before = text[start - a:start + o] if a else None
        if words:
            head = _ends(model, text, start + o, before, words[0])
            if words[0] in head:
                out.extend(((a, o), x) for x in tail)
        else:
            last = _ends(model, text, start + o, before, stop)
            out.extend(((a, o), x) for x in _exits(model, last, end, len(text), start + o))
            if start + o >= end:  # one piece lies across the whole chunk
                out.append(((a, o), (a + end - start, start + o - end)))
    return out


def trace(model: Pieces, text: str, start: int, end: int, entry: State, leave: State) -> bytes:
    """Ids of the pieces that begin in [start, end), given the states of both cuts."""
    begin, stop = start + entry[1], end + leave[1]
    if begin >= end and leave[0] > end - start:
        return b""
    before = text[start - entry[0]:begin] if entry[0] else None
    words = _cuts(text, start, end - 1)
    if words and words[0] >= begin:
        head = _trace(_ends(model, text, begin, before, words[0]), begin, words[0])
        tail = _trace(_ends(model, text, words[1], None, stop), words[1], stop)
        return (_packed(model, head) + encode_words(model, text[words[0]:words[1]])
                + _packed(model, tail))
    return _packed(model, _trace(_ends(model, text, begin, before, stop), begin, stop))


def combine(left: set[tuple[State, State]], right: set[tuple[State, State]],
            ) -> set[tuple[State, State]]:
    """Max-plus product of two transfer matrices, as their pairs of weight 0."""
    by_entry: dict[State, list[State]] = {}
    for a, b in right:
        by_entry.setdefault(a, []).append(b)
    return {(a, c) for a, b in left for c in by_entry.get(b, ())}


def product(matrices: list[list[tuple[State, State]]]) -> list[tuple[State, State]]:
    """The matrix of neighbouring chunks as one."""
    out = set(matrices[0])
    for m in matrices[1:]:
        out = combine(out, set(m))
    return sorted(out)


def scan(matrices: list[list[tuple[State, State]]], entry: State = (0, 0),
         leave: State | None = None) -> list[tuple[State, State]]:
    """The states of the cuts of neighbouring chunks between the state they are entered with and the
    one they are left with: products from the left say what can be reached, then the one path to the
    end is followed back. Without ``leave`` the last chunk ends the document."""
    reached: list[set[State]] = [{entry}]
    for m in matrices:
        reached.append({b for a, b in m if a in reached[-1]})
    state = next(s for s in reached[-1] if s[1] == 0) if leave is None else leave
    out = []
    for k in range(len(matrices) - 1, -1, -1):
        before = next(a for a, b in matrices[k] if b == state and a in reached[k])
        out.append((before, state))
        state = before
    return out[::-1]


_AT = "_doc long, _size int, k int, "
_STATE_COLUMNS = ["a", "o", "a2", "o2"]


def _matrix_of(steps: list[dict]) -> list[tuple[State, State]]:
    return [((x["a"], x["o"]), (x["a2"], x["o2"])) for x in steps]


def _steps_of(matrix: list[tuple[State, State]]) -> list[dict]:
    return [dict(zip(_STATE_COLUMNS, (*a, *b), strict=True)) for a, b in matrix]


def cut_states(steps: DataFrame, most: int) -> DataFrame:
    """(_doc, _size, k, a, o, a2, o2): the states before and behind every chunk, from the chunks'
    matrices. ``most`` is the largest number of chunks of a document.

    Matrices of ``SEGMENT`` neighbours are combined into one, these again, and so on until a document
    has few; then the states go back down, every segment by itself. No group holds more than
    ``SEGMENT`` matrices, however long a document is.
    """
    tasks = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["_doc", "_size", "g"]

    def spread(df: DataFrame) -> DataFrame:
        return df.repartition(tasks, *keys)  # few bytes, but much work: many tasks

    def combined(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["k"])
        pairs = product([_matrix_of(r["steps"]) for r in rows])
        return pa.Table.from_pylist([
            {"_doc": rows[0]["_doc"], "_size": rows[0]["_size"], "k": rows[0]["g"],
             "steps": _steps_of(pairs)}], _MATRICES)

    def scanned(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["k"])
        ends, first = {}, rows[0]
        if "from_a" in first:
            ends = {"entry": (first["from_a"], first["from_o"]), "leave": (first["to_a"], first["to_o"])}
        found = scan([_matrix_of(r["steps"]) for r in rows], **ends)
        return pa.Table.from_pylist([
            {"_doc": r["_doc"], "_size": r["_size"], "k": r["k"], **step}
            for r, step in zip(rows, _steps_of(found), strict=True)], _CUT_STATES)

    states = _AT + "a int, o int, a2 int, o2 int"
    segments = spread(steps.withColumn("g", F.floor(F.col("k") / SEGMENT).cast("int")))
    if most <= SEGMENT:
        return segments.groupBy(*keys).applyInArrow(scanned, states)
    above = cut_states(segments.groupBy(*keys).applyInArrow(
        combined, f"{_AT} steps {_STEPS}"), -(-most // SEGMENT)).select(
        "_doc", "_size", F.col("k").alias("g"), F.col("a").alias("from_a"), F.col("o").alias("from_o"),
        F.col("a2").alias("to_a"), F.col("o2").alias("to_o"))
    # both sides are spread before the join: behind it Spark would drop the exchange as one too many,
    # and pack the few bytes into one task
    return segments.join(spread(above), keys).groupBy(*keys).applyInArrow(scanned, states)


def _lists(parts: list[bytes | None]) -> pa.Array:
    sizes = np.array([len(p) // 4 if p is not None else 0 for p in parts])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.frombuffer(b"".join([p or b"" for p in parts]), dtype=np.int32)
    mask = pa.array([p is None for p in parts])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=mask)


def encode(docs: DataFrame, model: Pieces, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` plus ``ids`` (array of int)."""
    docs = docs.drop("ids")
    size = F.length(text)
    short = docs.filter(F.col(text).isNull() | (size < chunk))
    long = docs.filter(size >= chunk)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        "ids array<int>"])
    place, names = docs.columns.index(text), docs.columns

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, _SLICE):
                texts = [None if x is None else known.word.findall(normal(x))
                         for x in piece.column(place).to_pylist()]
                learn(known, set().union(*filter(None, texts)))
                ids = [None if x is None else encode_all(known, x) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(i) for i in range(len(names))), _lists(ids)],
                    names=[*names, "ids"])

    known = model
    done = for_python(short).mapInArrow(whole, schema)
    keyed = long.withColumn("_doc", F.xxhash64(text)).withColumn("_size", size)
    return done.unionByName(keyed.join(
        _encode_long(keyed, model, text, chunk), ["_doc", "_size"]).select(*names, "ids"))


def _encode_long(keyed: DataFrame, model: Pieces, text: str, chunk: int) -> DataFrame:
    """(_doc, _size, ids) of texts of several chunks; equal texts are encoded once."""
    margin = model.longest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_t"):
                for r in piece.to_pylist():
                    whole = normal(r["_t"])
                    parts = [whole[max(at - margin, 0):at + chunk + margin]
                             for at in range(0, len(whole), chunk)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["_doc"]] * len(parts), pa.int64()),
                         pa.array([r["_size"]] * len(parts), pa.int32()),
                         pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())],
                        names=["_doc", "_size", "k", "part"])

    chunks = for_python(keyed).select("_doc", "_size", F.col(text).alias("_t")).mapInArrow(
        cut, "_doc long, _size int, k int, part string").dropDuplicates(["_doc", "_size", "k"])

    def bounds(k: int, size: int) -> tuple[int, int]:
        start = min(k * chunk, margin)
        return start, start + min(chunk, size + 1 - k * chunk)

    def clipped(part: str, k: int, size: int) -> str:
        start, end = bounds(k, size)
        return part[:end + margin]

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                start, end = bounds(r["k"], r["_size"])
                out.append([{"a": a, "o": o, "a2": a2, "o2": o2} for (a, o), (a2, o2) in transfer(
                    model, clipped(r["part"], r["k"], r["_size"]), start, end)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), batch.column("_size"), batch.column("k"),
                 pa.array(out, _STATES)], names=["_doc", "_size", "k", "steps"])

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b, "part", _SLICE)):
            ids = []
            learn(model, set().union(*map(model.word.findall, batch.column(
                batch.schema.get_field_index("part")).to_pylist())))
            for r in batch.to_pylist():
                start, end = bounds(r["k"], r["_size"])
                ids.append(trace(model, clipped(r["part"], r["k"], r["_size"]), start, end,
                                 (r["a"], r["o"]), (r["a2"], r["o2"])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), batch.column("_size"), batch.column("k"), _lists(ids)],
                names=["_doc", "_size", "k", "ids"])

    steps = staged(for_python(chunks).mapInArrow(matrices, f"{_AT} steps {_STEPS}"), "piece-matrices")
    last = steps.agg(F.max("k")).first()[0]
    states = cut_states(steps, 1 if last is None else last + 1)
    parts = chunks.join(states, ["_doc", "_size", "k"]).mapInArrow(
        traced, "_doc long, _size int, k int, ids array<int>")
    return parts.groupBy("_doc", "_size").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))


_STEPS = "array<struct<a:int,o:int,a2:int,o2:int>>"
_STATES = pa.list_(pa.struct([(n, pa.int32()) for n in _STATE_COLUMNS]))
_PLACE = [("_doc", pa.int64()), ("_size", pa.int32()), ("k", pa.int32())]
_MATRICES = pa.schema([*_PLACE, ("steps", _STATES)])
_CUT_STATES = pa.schema([*_PLACE, *((n, pa.int32()) for n in _STATE_COLUMNS)])


def decode_ids(model: Pieces, ids: np.ndarray) -> str:
    return decode_lists(model, pa.array([ids], pa.list_(pa.int64())))[0]


def decode_lists(model: Pieces, lists: pa.Array) -> list[str | None]:
    """The text of each list of ids; their pieces are put in a row for all lists at once."""
    if model.column is None:
        model.column = pa.array(model.decoded, pa.large_binary())
    ids = np.arange(len(model.decoded))[lists.flatten().to_numpy(zero_copy_only=False)]
    got = model.column.take(pa.array(ids))
    _, offsets, data = got.buffers()
    at = np.frombuffer(offsets, np.int64)[:len(got) + 1]
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy()
    ends = at[np.cumsum(sizes)].tolist()
    raw = data.to_pybytes() if data is not None else b""
    out, start = [], 0
    for valid, end in zip(lists.is_valid().to_pylist(), ends, strict=True):
        first = start + (raw[start:start + 1] == b" " and start < end)
        out.append(raw[first:end].decode("utf-8", "replace") if valid else None)
        start = end
    return out


def decode(encoded: DataFrame, model: Pieces, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` plus the text of its ids; null ids have null text."""
    encoded = encoded.drop(text)
    names = encoded.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema),
                        f"`{text}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                got = decode_lists(model, piece.column(names.index(ids)))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(i) for i in range(len(names))), pa.array(got, pa.string())],
                    names=[*names, text])

    return for_python(encoded).mapInArrow(run, schema)


def same_text(text: Column, decoded: Column) -> Column:
    return text.eqNullSafe(decoded)
