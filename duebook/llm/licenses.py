"""Licence statements in texts.

One Aho-Corasick automaton over a text's words finds phrases that name a licence, notice phrases and identifier tags.
Behind a tag stands a licence expression; a shunting-yard parser turns it into postfix order and evaluates it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm.common import each_text, sums, text_blocks, without

#: Phrases that name a licence beyond doubt, and its label.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Words of other notices, their label, and how sure it is.
NOTICES = {
    "released under the mit license": ("mit", 1.0),
    "the mit license": ("mit", 0.8),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "licensed under the apache license version 2": ("apache-2", 1.0),
    "gnu general public license version 3": ("gpl-3", 1.0),
    "gnu general public license version 2": ("gpl-2", 1.0),
    "gnu general public license": ("gpl", 0.9),
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "bsd 3 clause": ("bsd-3", 0.9),
    "bsd 2 clause": ("bsd-2", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc by 4 0": ("cc-by", 0.9),
    "cc0 1 0": ("cc0", 0.9),
    "creative commons attribution": ("cc-by", 0.7),
    "released into the public domain": ("public-domain", 0.8),
    "all rights reserved": ("all-rights-reserved", 0.6),
}
TAG = "spdx license identifier"
TAG_PATTERN = re.compile(rb"spdx-license-identifier:[ \t]*([^\n\r]*)")
#: Identifiers of expressions that have a label of another name here.
SAME_AS = {
    "apache-2.0": "apache-2",
    "gpl-2.0": "gpl-2",
    "gpl-2.0-only": "gpl-2",
    "gpl-2.0-or-later": "gpl-2",
    "gpl-3.0": "gpl-3",
    "gpl-3.0-only": "gpl-3",
    "gpl-3.0-or-later": "gpl-3",
    "bsd-3-clause": "bsd-3",
    "bsd-2-clause": "bsd-2",
    "cc-by-4.0": "cc-by",
    "cc-by-sa-4.0": "cc-by-sa",
    "cc-by-nc-4.0": "cc-by-nc",
    "cc0-1.0": "cc0",
}
#: Identifiers of the public licence list that are in common use, in lower case.
IDENTIFIERS = frozenset(
    "0bsd aal afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 "
    "apache-2.0 apsl-1.0 apsl-2.0 artistic-1.0 artistic-2.0 beerware blueoak-1.0.0 bsd-1-clause bsd-2-clause "
    "bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 bzip2-1.0.6 cc-by-1.0 cc-by-2.0 cc-by-2.5 "
    "cc-by-3.0 cc-by-4.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 "
    "cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b "
    "cecill-c cpl-1.0 curl ecl-2.0 efl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.1-only gfdl-1.2-only gfdl-1.3-only "
    "gfdl-1.3-or-later gpl-1.0 gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only "
    "gpl-3.0-or-later hpnd icu ijg imagemagick intel ipl-1.0 isc jasper-2.0 lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 "
    "lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng libpng-2.0 libtiff lpl-1.02 lppl-1.3c mit mit-0 "
    "mit-cmu miros mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa netcdf nist-pd odbl-1.0 odc-by-1.0 ofl-1.0 ofl-1.1 "
    "oldap-2.8 openssl osl-2.1 osl-3.0 pddl-1.0 php-3.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sgi-b-2.0 sissl "
    "sleepycat spl-1.0 sspl-1.0 tcl ucl-1.0 unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim vsl-1.0 w3c watcom-1.0 wtfpl x11 "
    "xnet zend-2.0 zlib zpl-2.1".split()
)
#: Identifiers that refer to a licence beside the text.
REFERENCE = re.compile(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")
#: Labels whose texts may be used without conditions on what is made from them.
PERMISSIVE = frozenset({"mit", "apache-2", "bsd", "bsd-2", "bsd-3", "cc0", "cc-by", "public-domain", "isc", "zlib", "unlicense"})

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_base", T.LongType(), False),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.ArrayType(T.StringType(), False), False),
        T.StructField("labels", T.ArrayType(T.StringType(), False), False),
        T.StructField("expressions", T.ArrayType(T.StringType(), False), False),
        T.StructField("permissive", T.BooleanType()),
        T.StructField("score", T.DoubleType(), False),
    ]
)

# ---- expressions --------------------------------------------------------------------------------------------------

#: How tightly the operators bind.
BINDS = {"or": 1, "and": 2, "with": 3}
IDENTIFIER = re.compile(r"[a-z0-9][a-z0-9.+:-]*")


@dataclass(frozen=True)
class Licence:
    """labels: every licence named; permissive: whether the expression can be met by permissive licences alone."""

    labels: frozenset[str]
    permissive: bool


def postfix(expression: str) -> list[str]:
    """Identifiers and operators in postfix order; what is not well formed raises ValueError."""
    out: list[str] = []
    stack: list[str] = []
    operand = True
    for token in re.findall(r"[()]|[^\s()]+", expression.lower()):
        if token == "(":
            if not operand:
                raise ValueError(expression)
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if operand or not stack:
                raise ValueError(expression)
            stack.pop()
        elif token in BINDS:
            if operand:
                raise ValueError(expression)
            while stack and BINDS.get(stack[-1], 0) >= BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        else:
            if not operand or not IDENTIFIER.fullmatch(token):
                raise ValueError(expression)
            out.append(token)
            operand = False
    if operand or "(" in stack:
        raise ValueError(expression)
    return out + stack[::-1]


def evaluate(expression: str) -> Licence:
    """`or` needs one side, `and` both; `with` adds permissions to its left side and names no licence itself.

    Words that are no known identifier name no licence, and nothing that needs them is permissive.
    """
    stack: list[tuple[set[str], bool]] = []
    for token in postfix(expression):
        if token in BINDS:
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append(left)
            else:
                either = left[1] or right[1] if token == "or" else left[1] and right[1]
                few, many = sorted((left[0], right[0]), key=len)
                many |= few
                stack.append((many, either))
        else:
            name = token.rstrip("+")
            label = SAME_AS.get(name, name)
            known = name in IDENTIFIERS or label in PERMISSIVE or REFERENCE.fullmatch(name)
            stack.append(({label} if known else set(), label in PERMISSIVE))
    labels, permissive = stack.pop()
    return Licence(frozenset(labels), permissive)


def tag_expression(rest: str) -> str | None:
    """The longest well-formed expression at the start of what follows a tag, found in one pass over all tokens."""
    tokens = re.findall(r"[()]|[^\s()]+", rest)
    best, depth, operand = None, 0, True
    for n, token in enumerate(tokens):
        word = token.lower()
        if token == "(":
            if not operand:
                break
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            depth -= 1
            if not depth:
                best = n, token
        elif word in BINDS:
            if operand:
                break
            operand = True
        else:
            if not operand:
                break
            ended = token.rstrip(",;.*/ ")
            if not depth and ended.lower() not in BINDS and IDENTIFIER.fullmatch(ended.lower()):
                best = n, ended
            if not IDENTIFIER.fullmatch(word):
                break
            operand = False
    return " ".join([*tokens[: best[0]], best[1]]) if best else None


# ---- texts --------------------------------------------------------------------------------------------------------

#: Lower-case letters and digits stay, A-Z are lowered, all else of ASCII separates words; other bytes belong to words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_IS_WORD = np.frombuffer(_WORD_BYTES, np.uint8) != 32
_AUTOMATON: list[ahocorasick.Automaton] = []


def automaton() -> ahocorasick.Automaton:
    """Phrases with a blank on either side; values: (words, base label, notice, is a tag)."""
    if not _AUTOMATON:
        made = ahocorasick.Automaton()
        for phrase in {*BASE_PHRASES, *NOTICES, TAG}:
            made.add_word(f" {phrase} ", (len(phrase) + 2, BASE_PHRASES.get(phrase), NOTICES.get(phrase), phrase == TAG))
        made.make_automaton()
        _AUTOMATON.append(made)
    return _AUTOMATON[0]


def scan(text: bytes, words: str) -> tuple:
    """FOUND less n_words. words: the text's words between single blanks, a blank at both ends."""
    begins: list[int] = []
    base_labels, labels, expressions, permissive, score, tagged = set(), set(), [], None, 0.0, False
    for end, (length, label, notice, is_tag) in automaton().iter(words):
        if label:
            begins.append(end - length + 1)
            base_labels.add(label)
            score = 1.0
        if notice:
            labels.add(notice[0])
            score = max(score, notice[1])
        tagged |= is_tag
    if tagged:
        for match in TAG_PATTERN.finditer(text.lower()):
            expression = tag_expression(match[1].decode(errors="replace"))
            licence = evaluate(expression) if expression else None
            if licence and licence.labels:
                expressions.append(expression)
                labels |= licence.labels
                permissive = licence.permissive and permissive is not False
                score = 1.0
    base: list[int] = []
    if begins:
        # A phrase begins with the blank before its first word, so the blanks before that are the words before it.
        blanks = np.flatnonzero(np.frombuffer(words.encode("latin-1"), np.uint8) == 32)
        base = np.searchsorted(blanks, begins).tolist()
    labels |= base_labels
    if permissive is None and labels:
        permissive = labels <= PERMISSIVE
    return len(base), min(base, default=None), max(base, default=None), sorted(base_labels), sorted(labels), expressions, permissive, score


@F.arrow_udf(FOUND)
def _scans(texts: pa.Array) -> pa.Array:
    rows, counts = [], []
    for data, offsets in text_blocks(texts):
        inside = _IS_WORD[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[first] = inside[first]
        counts.append(sums(begins, offsets))
        for text in each_text(data, offsets):
            words = b" ".join(text.translate(_WORD_BYTES).split())
            rows.append(scan(text, f" {words.decode('latin-1')} "))
    columns = [np.concatenate(counts) if counts else np.zeros(0, np.int64), *(zip(*rows) if rows else [[]] * 8)]
    kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 3 + [pa.bool_(), pa.float64()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=FOUND.names)


def with_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """The table with the columns of FOUND; columns of these names are replaced.

    first_word and last_word are the smallest and largest start of a base phrase, words counted from 0; null without
    one. labels holds the base labels too. permissive is null if nothing was found. Null and empty texts have no words
    and no labels. Overlapping places all count; texts are read whole.
    """
    df = without(df, *FOUND.names)
    names = [f"`{c}`" for c in df.columns]
    found = df.select(*names, _scans(F.coalesce(df[f"`{text}`"], F.lit(""))).alias("_found"))
    return found.select(*names, *[F.col(f"_found.{n}").alias(n) for n in FOUND.names])
