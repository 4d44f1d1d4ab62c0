"""Scalar functions on literal tables, with brute force where there is any choice."""

import random
import re
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from sievemill.functions import fixed, literals, sequences, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, bare", [("https://arxiv.org/abs/2401.00001v2", "2401.00001"), (" http://arxiv.org/pdf/2401.00001v12.pdf ", "2401.00001"), ("math/0101001v1", "math/0101001"), ("2401.00001/", "2401.00001")])
def test_paper_ids(spark, raw, bare):
    assert one(spark, text.normalize_paper_id(F.col("t")), t=raw) == bare


def test_tex(spark):
    raw = "A \\textbf{bold} claim\\cite{x} % note\nwith 5\\% loss and \\section*[s]{head}"
    assert one(spark, text.clean_tex(F.col("t")), t=raw) == "A bold claim with 5\\% loss and head"
    doc = "x \\begin{figure}[t] \\includegraphics[width=1]{ a.png } \\caption{A {nested} one} \\label{fig:a}\\label{tab:b}\\end{figure} y \\begin{figure*}z\\end{figure*}"
    bodies = one(spark, text.figure_bodies(F.col("t")), t=doc)
    assert len(bodies) == 2 and bodies[1] == "z"
    assert one(spark, text.figure_labels(F.col("t")), t=bodies[0]) == ["fig:a"]
    assert one(spark, text.figure_images(F.col("t")), t=bodies[0]) == ["a.png"]
    assert one(spark, literals.command_argument(F.col("t"), "caption"), t=bodies[0]) == "A {nested} one"
    assert one(spark, literals.command_argument(F.col("t"), "caption"), t="\\caption{a \\} b}") == "a \\} b"
    assert one(spark, literals.command_argument(F.col("t"), "caption"), t="\\caption{open") == ""


def test_render_strict(spark):
    assert one(spark, text.render(F.lit("{{ a }}-{{ b }}"), {"a": F.lit("x"), "b": F.lit("y")}, strict=True)) == "x-y"
    with pytest.raises(Exception, match="must occur once"):
        one(spark, text.render(F.lit("{{ a }}{{ a }}"), {"a": F.lit("x")}, strict=True))


def test_partition_and_context(spark):
    assert tuple(one(spark, text.partition_first(F.col("t"), ";"), t="a;b;c")) == ("a", "b;c")
    assert tuple(one(spark, text.partition_first(F.col("t"), ";"), t="abc")) == ("abc", "")
    assert tuple(one(spark, text.variant_context(F.col("t")), t="On Chromosome X at position 123 in BRCA1 (DNA repair)")) == ("X", "123", "BRCA1")
    assert one(spark, text.variant_context(F.col("t")), t="nothing here")["gene"] is None
    assert one(spark, text.choices_text(F.array(F.lit(" A. x "), F.lit("B. y")))) == "Choices:\nA. x\nB. y"


def translate_all(s):
    table = dict(zip((a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"), fixed.AMINO_ACIDS))
    out = []
    for m in re.finditer("(?=ATG)", s):
        p = "".join(table[s[i : i + 3]] for i in range(m.start(), len(s) - 2, 3))
        if "*" in p:
            out.append(p[: p.index("*") + 1])
    return out


def test_proteins(spark):
    rng = random.Random(5)
    cases = ["ATGATGTAA", "ATGAAA", "", "AT", "ATGTAG"] + ["".join(rng.choice("ACGT") for _ in range(150)) for _ in range(20)]
    rows = spark.createDataFrame([(s,) for s in cases], "s string").select("s", sequences.complete_proteins(F.col("s")).alias("p")).collect()
    assert translate_all("ATGATGTAA") == ["MM*", "M*"]
    for r in rows:
        assert r["p"] == translate_all(r["s"]), r["s"]
    assert one(spark, sequences.longest_unique(F.array(F.lit("ab"), F.lit("cd")))) is None


def test_strands_and_amplicons(spark):
    assert one(spark, sequences.reverse_complement(F.col("s")), s="ATGC") == "GCAT"
    forward, reverse = "ACGTACGTACGTACG", "TTTGGGCCCAAATTT"
    back = reverse[::-1].translate(str.maketrans("ACGT", "TGCA"))
    product = forward + "CCCC" + back
    for a, b in ((forward, reverse), (reverse, forward)):
        assert one(spark, sequences.amplicons(F.col("s"), F.col("a"), F.col("b")), s="GG" + product + "GG", a=a, b=b) == [product]
    assert one(spark, sequences.gc_percent(F.col("s")), s="GCAATTTT") == 25
    assert one(spark, sequences.gc_percent(F.col("s")), s="GAAAAAAA") == 13  # 12.5, half up


def test_changes(spark):
    rng = random.Random(1)
    a = "".join(rng.choice("ACGT") for _ in range(300))
    kinds = {a: "identical", a[:100] + ("A" if a[100] != "A" else "C") + a[101:]: "single_substitution", a[:100] + "ACGTT" + a[100:]: "insertion", a[:100] + a[105:]: "deletion", a[:30]: "other"}
    for b, kind in kinds.items():
        found = one(spark, sequences.classify_change(F.col("a"), F.col("b")), a=a, b=b)
        assert kind in found["kind"]
    assert one(spark, sequences.hamming(F.col("a"), F.col("b")), a="ACGT", b="AGGA") == 2
    assert one(spark, sequences.hamming(F.col("a"), F.col("b")), a="ACGT", b="A") is None
    assert one(spark, sequences.first_difference(F.col("a"), F.col("b")), a="ACGT", b="AC") == 2
    assert one(spark, sequences.apply_mutation(F.col("s"), F.col("m")), s="MKV", m="K2A") == "MAV"
    assert one(spark, sequences.apply_mutation(F.col("s"), F.col("m")), s="MKV", m="A2K") is None


def slow_align(a, b):
    @lru_cache(None)
    def best(i, j):
        if not i or not j:
            return (-2 * (i + j), 0, 0)
        s, m, n = best(i - 1, j - 1)
        same = a[i - 1] == b[j - 1]
        options = [(s + (2 if same else -1), m + same, n + 1)]
        for x in (best(i - 1, j), best(i, j - 1)):
            options.append((x[0] - 2, x[1], x[2]))
        return max(options)

    _, matches, pairs = best(len(a), len(b))
    return (matches / pairs if pairs else 0.0, pairs / max(len(a), len(b)))


def test_alignment(spark):
    rng = random.Random(2)
    pairs = [("".join(rng.choice("ACDE") for _ in range(rng.randint(1, 14))), "".join(rng.choice("ACDE") for _ in range(rng.randint(1, 14)))) for _ in range(60)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", sequences.alignment("a", "b").alias("x")).collect()
    for r in rows:
        assert (r["x"]["identity"], r["x"]["coverage"]) == pytest.approx(slow_align(r["a"], r["b"]))


@pytest.mark.parametrize("raw, want", [("benign", ("benign", [], False)), ("Benign; x", (None, None, True)), ("pathogenic", ("pathogenic", None, False)), ("pathogenic; Not Provided", ("pathogenic", None, False)), ("pathogenic; ['a', 'b']", ("pathogenic", ["a", "b"], False)), ("pathogenic; [1]", (None, None, True)), ("pathogenic; [", (None, None, True)), ("pathogenic; a_b", ("pathogenic", ["a_b"], False)), ("other", (None, None, True))])
def test_labels(spark, raw, want):
    found = one(spark, literals.parse_label(F.col("t")), t=raw)
    assert (found["pathogenicity"], found["diseases"], found["error"]) == want


@pytest.mark.parametrize("raw, want", [("['A. x'\n 'B. material's y']", ["A. x", "B. material's y"]), ("['x', \"y\"]", ["x", "y"]), ("nan", None), ("[1, 2]", ["1", "2"]), ("plain", ["plain"])])
def test_choices(spark, raw, want):
    assert one(spark, literals.parse_choices(F.col("t")), t=raw) == want


def test_keys_boxes_repairs(spark):
    assert one(spark, literals.disease_key(F.col("t")), t="Straße_ﬁx  (A)") == "strasse fix a"
    assert one(spark, literals.boxed_answer(F.col("t")), t="\\boxed{1} and $\\boxed{ {x}^2 }$ then \\boxed{open") == "{x}^2"
    assert one(spark, literals.repair_json(F.col("t")), t='```json\n{"a": "\\alpha"}\n```') == '{"a": "\\\\alpha"}'
    assert one(spark, literals.repair_json(F.col("t")), t="text {\"b\": 1} more") == '{"b": 1}'
    assert one(spark, literals.repair_json(F.col("t")), t="none") is None
    assert one(spark, literals.coalesce_answer(F.col("a"), F.col("b")), a="null", b='{"z": 1, "a": 2}') == '{"a": 2, "z": 1}'


def test_mended_json_by_hand():
    from sievemill.functions.literals import mend_json

    assert mend_json('{"a": 1}') == '{"a": 1}'
    assert mend_json('```json\n{"b": {"c": "}"}, "a": [1]}\n```') == '{"a": [1], "b": {"c": "}"}}'
    assert mend_json('so: {"a": "\\alpha and \\u00e9 and \\"x"} there') == '{"a": "\\\\alpha and é and \\"x"}'
    assert mend_json('{"a": "two\nlines"}') == '{"a": "two\\nlines"}'
    for bad in (None, "", "none", "[1]", '{"a": 1', '{"a": 1} more', 'x {"a": 1} y }', '{"a" 1}', '{"a": "\\uzz"}'):
        assert mend_json(bad) is None, bad
