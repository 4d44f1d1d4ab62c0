"""Counts over molecular graphs written as SMILES: atoms and their neighbours, no chemistry beyond that."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.functions.fixed import ELEMENTS

COUNTS = ("carbon_atom", "hetero_atom", "halogen_atom", "heavy_atom", "chain_termini", "branch_point", "n_atoms")
_TOKEN = re.compile(
    r"\[(?P<isotope>\d*)(?P<symbol>\*|[A-Z][a-z]?|[a-z][a-z]?)(?P<chiral>@[^\]H+-]*)?(?P<h>H\d*)?(?P<charge>[+-]+\d*)?(?::\d+)?\]"
    r"|(?P<plain>Br|Cl|[BCNOPSFI]|[bcnops]|\*)|(?P<ring>%\(\d+\)|%\d\d|\d)|(?P<other>[-=#$:/\\~.()])"
)


def _element(symbol: str) -> str | None:
    """Symbol with its capital; None where there is no such element."""
    name = symbol[0].upper() + symbol[1:]
    return name if name in ELEMENTS or name == "*" else None


def graph(smiles: str) -> tuple[list[str], list[set[int]]] | None:
    """(element, neighbours) of each atom; hydrogens that are only written out are left away: without isotope or charge,
    with one neighbour that isn't hydrogen. None for what isn't SMILES; valences and aromatic rings aren't checked."""
    elements, near, plain = [], [], []
    opened: dict[int, int] = {}
    stack, last, at = [], None, 0

    def bond(a: int, b: int) -> bool:
        fine = a != b and b not in near[a]
        near[a].add(b)
        near[b].add(a)
        return fine

    while at < len(smiles):
        m = _TOKEN.match(smiles, at)
        if m is None:
            return None
        at = m.end()
        if symbol := m["symbol"] or m["plain"]:
            if (element := _element(symbol)) is None:
                return None
            elements.append(element)
            near.append(set())
            plain.append(not m["isotope"] and not m["charge"])
            if last is not None:
                bond(last, len(elements) - 1)
            last = len(elements) - 1
        elif ring := m["ring"]:
            if last is None:
                return None
            name = int(ring.strip("%()"))
            if name in opened:
                if not bond(opened.pop(name), last):
                    return None
            else:
                opened[name] = last
        elif m["other"] == "(":
            stack.append(last)
        elif m["other"] == ")":
            if not stack:
                return None
            last = stack.pop()
        elif m["other"] == ".":
            last = None
    if opened or stack or not elements:
        return None
    written = {i for i, e in enumerate(elements) if e == "H" and plain[i] and len(near[i]) == 1 and elements[next(iter(near[i]))] != "H"}
    kept = [i for i in range(len(elements)) if i not in written]
    return [elements[i] for i in kept], [near[i] - written for i in kept]


def counts(smiles: str | None) -> tuple[int, ...] | None:
    """COUNTS of one molecule."""
    found = graph(smiles or "")
    if found is None:
        return None
    elements, near = found
    degrees = [len(n) for e, n in zip(elements, near) if e == "C"]
    hetero = [e for e in elements if e not in ("H", "C")]
    return len(degrees), len(hetero), sum(e in ("F", "Cl", "Br", "I") for e in elements), len(degrees) + len(hetero) - hetero.count("*"), degrees.count(1), sum(d >= 3 for d in degrees), len(elements)


@F.pandas_udf(T.StructType([T.StructField(c, T.IntegerType()) for c in COUNTS]))
def atom_counts(smiles: pd.Series) -> pd.DataFrame:
    """struct of COUNTS; all null for null, empty or unreadable SMILES."""
    rows = [counts(s) or (None,) * len(COUNTS) for s in smiles]
    return pd.DataFrame(rows, columns=list(COUNTS), index=smiles.index).astype("Int32")
