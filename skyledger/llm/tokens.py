"""Token counts of whole texts, huge ones by overlapping chunks that are spliced.

A text above ``CHUNK`` characters is encoded in chunks that overlap, with
offsets. Neighbouring chunks are spliced at a position where both begin a
pre-token and agree on the tokens up to the next such position. It is proven
stable: splitters scan from left to right, so the left chunk, which begins
at a stable position, splits there as the whole text does, and from a
position where a pre-token begins the right chunk splits on as the whole text
does; the normaliser must not join the characters on its two sides. Where the
overlap has no such position it is widened and the right chunk encoded again;
where the left chunk has none (one endless word), the left chunk is doubled.

Other texts go to the library in batches. If the vocabulary drops white space,
its tokens are those of the pieces between white space: then the counts of
pieces are remembered, and the library sees a piece when it is new.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, OVERLAP = 50_000, 400      # characters
BATCH_CHARS = 2_000_000
REMEMBERED = 1_000_000             # pieces that a worker process remembers
LONGEST_PIECE = 64                # bytes of a remembered piece
PARTS = re.compile(rb"[A-Za-z]+|[^A-Za-z]+")
#: Splitter alternatives that can't match white space, besides contractions.
SPACELESS = {r"[\p{L}]+", r"\p{L}+", r"[\p{N}]", r"\p{N}", r"[\p{N}]+", r"\p{N}+", r"[^\s\p{L}\p{N}]+"}
#: Normalisers that treat the two sides of white space apart.
LOCAL_NORMALISERS = {"NFC", "NFD", "Lowercase"}


def load(path: str):
    """The tokenizer of a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file."""
    if path.endswith(".model"):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


def drops_white_space(tokenizer) -> bool:
    """Whether the tokens of a text are those of its pieces between white space, as its description shows.

    True if the splitter keeps only matches that can't hold white space (runs
    of letters, of digits, of signs, or contractions), and every normaliser
    step works on either side of white space by itself.
    """
    about = json.loads(tokenizer.to_str())
    steps = about.get("normalizer") or {"type": "Sequence", "normalizers": []}
    for step in steps["normalizers"] if steps["type"] == "Sequence" else [steps]:
        spaces = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if not spaces and step["type"] not in LOCAL_NORMALISERS:
            return False
    splits = about.get("pre_tokenizer") or {"type": None}
    first, *rest = splits["pretokenizers"] if splits["type"] == "Sequence" else [splits]
    if any(x["type"] != "ByteLevel" or x["add_prefix_space"] for x in rest):
        return False
    if first["type"] != "Split" or first["behavior"] != "Removed" or not first["invert"] or "Regex" not in first["pattern"]:
        return False
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \t\n\r\v\f") for t in about["added_tokens"]):
        return False
    known = lambda x: x in SPACELESS or re.fullmatch("'[a-z]+", x)
    return about.get("post_processor") is None and all(map(known, first["pattern"]["Regex"].split("|")))


class Pieces:
    """Tokens of pieces between white space, remembered by a worker; forgotten when :data:`REMEMBERED` are held.

    A new piece is cut further where an ASCII letter meets an ASCII sign or digit (apostrophes
    excepted: they may begin a contraction), which always is a border of the splitter, and
    lower-cased if the vocabulary does so. Pieces that hold a special string stay as they are.
    """

    def __init__(self, tokenizer, limit: int = REMEMBERED):
        about = json.loads(tokenizer.to_str())
        self.tokenizer, self.limit = tokenizer, limit
        special = b"|".join(re.escape(t["content"].encode("utf-8")) for t in about["added_tokens"])
        self.special = re.compile(special or b"(?!)", re.I)     # in any case: lower-casing must not make one
        self.lower = "Lowercase" in json.dumps(about.get("normalizer"))
        self.pieces: dict[bytes, int] = {}
        self.parts: dict[bytes, int] = {}

    def _cut(self, piece: bytes) -> list[bytes]:
        if self.special.search(piece):
            return [piece]
        whole = piece.lower() if self.lower else piece
        return PARTS.findall(whole) if whole.isascii() and b"'" not in whole else [whole]

    def _learn(self, new: list[bytes]) -> None:
        """Encode new parts as one text, :data:`CHUNK` characters at a time; a token belongs to the part it starts in."""
        cut = [self._cut(p) for p in new]
        parts = list(set().union(*cut).difference(self.parts))
        texts = [p.decode("utf-8") for p in parts]
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        cuts = [0, *(np.flatnonzero(np.diff(starts // CHUNK)) + 1).tolist(), len(texts)]
        for lo, hi in zip(cuts, cuts[1:]):
            e = self.tokenizer.encode(" ".join(texts[lo:hi]), add_special_tokens=False)
            at = np.searchsorted(starts[lo:hi] - starts[lo], [s for s, _ in e.offsets], "right") - 1
            self.parts.update(zip(parts[lo:hi], np.bincount(at, minlength=hi - lo).tolist()))
        held = self.parts
        for p, c in zip(new, cut):
            self.pieces[p] = held[c[0]] if len(c) == 1 else sum([held[x] for x in c])

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text: :meth:`bytes.split` parts at ASCII white space, which every splitter counts as such."""
        split = [t.encode("utf-8").split() for t in texts]
        new = set().union(*split).difference(self.pieces)
        if len(self.pieces) + len(self.parts) + len(new) > self.limit:
            self.pieces.clear()
            self.parts.clear()
            new = set().union(*split)
        self._learn(list(new))
        out = [sum(map(self.pieces.__getitem__, pieces)) for pieces in split]
        for p in new:
            if len(p) > LONGEST_PIECE:
                del self.pieces[p]
                for x in self._cut(p):
                    self.parts.pop(x, None)
        return out


_LOADED: dict = {}


def loaded(path: str):
    """Tokenizer and remembered pieces (None if the vocabulary keeps white space) of a file, kept by a worker process."""
    if path not in _LOADED:
        tokenizer = load(path)
        _LOADED[path] = tokenizer, Pieces(tokenizer) if not path.endswith(".model") and drops_white_space(tokenizer) else None
    return _LOADED[path]


def _encode(tokenizer, text: str, lo: int, hi: int):
    """Of the chunk ``text[lo:hi]``: ids, their starts in ``text``, and the indexes of those that begin a pre-token."""
    e = tokenizer.encode(text[lo:hi], add_special_tokens=False)
    words = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
    first = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (words[1:] < 0)]) if len(words) else np.zeros(0, np.int64)
    return np.array(e.ids, np.int64), np.array([s for s, _ in e.offsets], np.int64) + lo, first


def _apart(text: str, x: int) -> bool:
    """Whether normal forms of what is before ``x`` and from it on don't touch: characters compose with at most three before."""
    c, before = text[x], text[max(0, x - 3):x]
    nfc = lambda t: unicodedata.normalize("NFC", t)
    return not unicodedata.combining(c) and nfc(before + c) == nfc(before) + nfc(c)


def _stable(text: str, chunk, lo: int, hi: int) -> list[int]:
    """Starts of pre-tokens of a chunk in (lo, hi)."""
    _, starts, first = chunk
    at = starts[first]
    return at[(at > lo) & (at < hi)].tolist()


def _common_boundary(text: str, left, right, lo: int, hi: int):
    """First position in (lo, hi) proven stable for both encodings, as token counts before it; None if there is none."""
    (li, ls, _), (ri, rs, _) = left, right
    shared = sorted(set(_stable(text, left, lo, hi)) & set(_stable(text, right, lo, hi)))
    shared = [x for x in shared if _apart(text, x)]
    for x, y in zip(shared, shared[1:]):  # the tokens from x to the next stable boundary agree
        a, b = np.searchsorted(ls, [x, y]), np.searchsorted(rs, [x, y])
        if np.array_equal(li[a[0]:a[1]], ri[b[0]:b[1]]) and np.array_equal(ls[a[0]:a[1]], rs[b[0]:b[1]]):
            return int(a[0]), int(b[0]), x
    return None


def count_spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text`` as encoding it whole gives them."""
    if len(text) <= chunk:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)
    start, end, total, base = 0, chunk, 0, 0   # `base` tokens of the left chunk, those before `start`, are counted
    left = _encode(tokenizer, text, start, end)
    while end < len(text):
        stable, wide, met = _stable(text, left, start, end), overlap, None
        while len(stable) > 1 and met is None:
            lo = max(start, stable[-2] - wide)
            stop = min(len(text), max(lo + chunk, end + chunk // 2))
            right = _encode(tokenizer, text, lo, stop)
            met = _common_boundary(text, left, right, lo, end)
            if lo == start:
                break
            wide *= 2
        if met:
            total += met[0] - base
            left, base, start, end = right, met[1], met[2], stop
        else:
            end = min(len(text), start + 2 * (end - start))
            left, base = _encode(tokenizer, text, start, end), 0
    return total + len(left[0]) - base


def count_batch(tokenizer, texts: list, pieces: Pieces | None = None) -> list[int]:
    """Token counts of texts in their order; null counts as empty."""
    out = [0] * len(texts)
    held, size = [], 0

    def flush():
        if pieces is not None:
            for i, n in zip(held, pieces.count([texts[i] for i in held]), strict=True):
                out[i] = n
            return
        for i, e in zip(held, tokenizer.encode_batch_fast([texts[i] for i in held], add_special_tokens=False), strict=True):
            out[i] = len(e)

    for i, t in enumerate(texts):
        if not t:
            continue
        if len(t) > CHUNK:
            out[i] = count_spliced(tokenizer, t)
            continue
        held.append(i)
        size += len(t)
        if size >= BATCH_CHARS:
            flush()
            held, size = [], 0
    flush()
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    Tokens are the library's for the file at ``tokenizer_path`` (read on each
    executor), without added special tokens, truncation or padding. Null texts
    count as empty: no bytes, no tokens. Null ids are kept; repeated rows give
    repeated rows; other columns are ignored; an empty table gives an empty
    result. Pieces of a ``.model`` file may depend on the whole text, which
    is then encoded whole.
    """
    def run(batches):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        tokenizer, pieces = loaded(tokenizer_path)
        for b in batches:
            texts = b.column("text").to_pylist()
            if tokenizer_path.endswith(".model"):
                n = [len(tokenizer.encode(t or "", num_threads=1)) for t in texts]
            else:
                n = count_batch(tokenizer, texts, pieces)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
