"""Tokenizers (C6) behind one interface: counts, and cuts of a text at its tokens.

A tokenizer gives Columns: ``count(text)``, ``last(text, n)`` and
``first(text, n)``.  The two cuts are substrings of the text, found through
the tokens' offsets, so what a model is shown keeps its spacing; a text of
``n`` tokens or fewer stays as it is.

``PatternTokenizer`` (``WORDS`` is the default) works in built-in functions.
``ArrowTokenizer`` takes a user's tokenizer into Arrow batches: a function
from a list of texts to (ids, starts, ends) for each, offsets in characters.
It is made on the executors, once in each Python worker, by the factory that
was passed, so a tokenizer need not be picklable and its files are read where
they are used.

Nulls count 0 tokens and stay null when cut.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from kiln.functions.text import TOKEN_PATTERN, token_count

__all__ = ["PatternTokenizer", "ArrowTokenizer", "WORDS", "SPANS", "library_tokenizer", "short_pieces"]

#: (ids, starts, ends) of a text.
SPANS = "struct<ids:array<int>,starts:array<int>,ends:array<int>>"

_loaded: dict[str, Callable] = {}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


class PatternTokenizer:
    """Tokens are the matches of ``pattern`` in order; ``gap`` matches one character between them."""

    def __init__(self, pattern: str = TOKEN_PATTERN, gap: str = "[\\t\\n\\x0B\\f\\r ]"):
        self.pattern, self.gap = pattern, gap

    def count(self, text) -> Column:
        return token_count(text, self.pattern)

    def last(self, text, n: int) -> Column:
        t = _c(text)
        parts = F.regexp_extract_all(t, F.lit(f"(?:{self.pattern}){self.gap}*"), 0)  # a token and the gap behind it
        over = F.size(parts) > n
        return F.when(over, F.array_join(F.slice(parts, F.size(parts) - F.lit(n - 1), n), "")).otherwise(t) if n > 0 else (
            F.when(over, F.lit("")).otherwise(t))

    def first(self, text, n: int) -> Column:
        t = _c(text)
        parts = F.regexp_extract_all(t, F.lit(f"{self.gap}*(?:{self.pattern})"), 0)  # a token and the gap before it
        return F.when(F.size(parts) > n, F.array_join(F.slice(parts, 1, n), "")).otherwise(t)


WORDS = PatternTokenizer()


class ArrowTokenizer:
    """A user's tokenizer: ``factory()`` returns a function from a list of texts to (ids, starts, ends) for each.

    ``name`` tells tokenizers apart within a worker; the same name must mean the same tokenizer.
    """

    def __init__(self, name: str, factory: Callable[[], Callable[[list], list]]):
        self.name, self.factory = name, factory

    def _udf(self, per_text: Callable, result: str, finish: Callable = lambda x: pd.Series(x, dtype=object)) -> Callable:
        name, factory = self.name, self.factory

        def run(batches):
            from kiln.functions import tokenize

            encode = tokenize._loaded.get(name)
            if encode is None:
                encode = tokenize._loaded[name] = factory()
            for texts in batches:
                known = texts.notna()
                spans = iter(encode(texts[known].tolist()))
                yield finish([per_text(t, next(spans)) if k else per_text(None, None) for t, k in zip(texts, known)])

        return F.pandas_udf(run, result, functionType=F.PandasUDFType.SCALAR_ITER)

    def count(self, text) -> Column:
        return self._udf(lambda t, s: 0 if s is None else len(s[0]), "int")(_c(text))

    def spans(self, text) -> Column:
        """The tokens themselves: ``SPANS``, with null fields for a null text."""
        names = ["ids", "starts", "ends"]
        return self._udf(lambda t, s: (None,) * 3 if s is None else [list(map(int, v)) for v in s], SPANS,
                         lambda x: pd.DataFrame(x, columns=names, dtype=object))(_c(text))

    def last(self, text, n: int) -> Column:
        def cut(t, s):
            return t if s is None or len(s[0]) <= n else t[s[1][len(s[0]) - n]:] if n else ""
        return self._udf(cut, "string")(_c(text))

    def first(self, text, n: int) -> Column:
        def cut(t, s):
            return t if s is None or len(s[0]) <= n else t[:s[2][n - 1]] if n else ""
        return self._udf(cut, "string")(_c(text))


def library_tokenizer(path: str) -> ArrowTokenizer:
    """A tokenizer of the ``tokenizers`` library, from its JSON file (a path that the executors can read)."""
    def factory():
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True

        def encode(texts):
            for e in model.encode_batch(texts, add_special_tokens=False):
                yield e.ids, [o[0] for o in e.offsets], [o[1] for o in e.offsets]

        return encode

    return ArrowTokenizer(f"library {path}", factory)


def short_pieces(width: int = 4) -> ArrowTokenizer:
    """A small example of a user's tokenizer: ASCII words in pieces of at most ``width`` characters, other characters
    one by one; the id is the piece's length and first letter in one number."""
    def factory():
        import re

        piece = re.compile(f"[A-Za-z0-9_]{{1,{width}}}|[^A-Za-z0-9_\\t\\n\\x0b\\f\\r ]")

        def encode(texts):
            for text in texts:
                found = list(piece.finditer(text))
                yield [len(m[0]) << 21 | ord(m[0][0]) for m in found], [m.start() for m in found], [m.end() for m in found]

        return encode

    return ArrowTokenizer(f"pieces of {width}", factory)
