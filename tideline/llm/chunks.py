"""Cut texts into parts whose tokenization doesn't depend on what stands beside them, and remember each part's ids.

A pre-tokenizer of the usual byte-level kind never lets a match run from a non-blank into a blank, so a text may be cut
before each single blank, and those pieces around single line ends and before signs that end a line or piece. Arrow does this
for a batch at once and finds the distinct pieces and parts, so only distinct parts are looked up, and the ids of texts are
gathered from theirs. Texts where blanks stand together, and those with the marks of a special token, are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts that are encoded at once.
GATHER = 16 << 20
#: White space, and some more that any library in use takes for it.
_BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_OTHER = _BLANK.replace(r"\t-\r", r"\t\x0b-\r")
#: Texts that aren't cut at blanks and line ends: those where more than one blank stands together (but two line ends within
#: a text), or one at the end, and those that may hold an added token.
WHOLE = rf"[{_BLANK}]\x20|\x20[{_BLANK}]|\n\n\n|[{_OTHER}]\n|\n[{_OTHER}]|[{_OTHER}]$|\n\n$|<\||\x00"
#: A match that ends in letters that all versions of Unicode know, and one of signs up to the end of the line.
SIGNS = r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{400}-\x{481}])([!-&(-/:-@\[-`{-~]+)(\n|$)"


def _gathered(ids: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The size[k] items of ids from place[k] on, for all k in a row."""
    upto = np.cumsum(size)
    return ids[np.repeat(place - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)]


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


class Parts:
    """Ids (bytes of u32, little-endian) of texts, by their parts.

    A subclass gives encode(), for any texts, and encode_parts(), for parts without blanks but a first one; line is what the
    line end is encoded as. Up to 2 * size parts of at most `longest` characters are remembered: a full generation becomes the
    old one, whose used entries return.
    """

    line = b""

    def __init__(self, size: int = 300_000, longest: int = 64):
        self.size, self.longest, self.known, self.old = size, longest, {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        return self.encode(parts)

    def known_or_new(self, parts: list[str]) -> list[bytes]:
        """The ids of each of these distinct parts."""
        known, old = self.known, self.old
        out = [known.get(p) for p in parts]
        new, alone = [], []
        for i in [i for i, x in enumerate(out) if x is None]:
            p = parts[i]
            if (x := old.get(p)) is not None:
                out[i] = known[p] = x
            elif p in ("", "\n"):
                out[i] = self.line if p else b""
            else:
                (alone if (p[0].isspace() and p[0] != " ") or p[1:2].isspace() or "\n" in p else new).append(i)
        for places, encode in ((new, self.encode_parts), (alone, self.encode)):
            for i, x in zip(places, encode([parts[i] for i in places]) if places else (), strict=True):
                out[i] = x
                if len(parts[i]) <= self.longest:
                    known[parts[i]] = x
        if len(known) > self.size:
            self.known, self.old = {}, known
        return out

    def __call__(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by end, and how many each has."""
        whole = pc.match_substring_regex(texts, WHOLE)
        rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        split = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        starts = split.offsets.to_numpy().astype(np.int64)
        words = split.values[starts[0] : starts[-1]].dictionary_encode()
        starts -= starts[0]
        code, names = words.indices.to_numpy().astype(np.int64), words.dictionary
        # a text's first word has no blank before it
        first, at = np.unique(code[starts[:-1]], return_inverse=True)
        pieces = pa.concat_arrays([pc.binary_join_element_wise(" ", names, ""), names.take(pa.array(first))])
        # texts that aren't cut, and the end, are pieces too
        code[starts[:-1]] = len(names) + at
        code[starts[rows]] = len(pieces) + np.arange(len(rows))
        code = np.insert(code, starts[1:], len(pieces) + len(rows))
        marked = pc.replace_substring(pc.replace_substring_regex(pieces, SIGNS, "\\1\0\\2\\3"), "\n", "\0\n\0")
        cut = pc.split_pattern(marked, "\0")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        own = cut.values[bounds[0] : bounds[-1]].dictionary_encode()
        entries = self.known_or_new(own.dictionary.to_pylist())
        size = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        part = own.indices.to_numpy()
        ids = _gathered(np.frombuffer(b"".join(entries), "<u4"), _starts(size)[part], size[part])
        size = np.add.reduceat(size[part], bounds[:-1] - bounds[0])
        more = [*self.encode([texts[i].as_py() for i in rows.tolist()]), end]
        ids = np.concatenate([ids, np.frombuffer(b"".join(more), "<u4")])
        size = np.concatenate([size, [len(x) // 4 for x in more]])
        out = _gathered(ids, _starts(size)[code], size[code])
        ends = np.cumsum(size[code])[starts[1:] + np.arange(len(texts))]
        return out, np.diff(ends, prepend=0)


def _halves(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most so many bytes, or of one row."""
    if batch.nbytes <= most or batch.num_rows < 2:
        yield batch
        return
    middle = batch.num_rows // 2
    yield from _halves(batch.slice(0, middle), most)
    yield from _halves(batch.slice(middle), most)


def together(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[list[pa.Array]]:
    """The columns of as many batches at once as have `most` (GATHER) bytes: the more, the more parts of a batch are the same.

    Batches that have more are cut, so less than twice as much is held at once, but for a longer row.
    """
    held, size = [], 0
    for b in (x for batch in batches for x in _halves(batch, most or GATHER)):
        if b.num_rows:
            held.append(b)
            size += b.nbytes
        if size >= (most or GATHER):
            yield [pa.concat_arrays(c) for c in zip(*(h.columns for h in held), strict=True)]
            held, size = [], 0
    if held:
        yield [pa.concat_arrays(c) for c in zip(*(h.columns for h in held), strict=True)]
