"""Patterns, word lists and constants that results depend on. Stated plainly, together."""

#: URL, suffix, slash and version around a preprint's id.
PAPER_URL = r"^https?://arxiv\.org/(?:abs|pdf)/"
PAPER_VERSION = r"v\d+\z"
#: A subject domain of a preprint server.
DOMAIN = r"[A-Za-z0-9.-]+"

#: What leaves a TeX fragment, in this order: comments, citations and footnotes, font commands, other commands, braces.
TEX_CLEANING = (
    r"(?<!\\)%[^\n]*",
    r"\\(?:cite|citep|citet|footnote)\s*\{[^}]*\}",
    r"\\(?:textbf|textit|emph|mathrm|mathbf|operatorname)\s*",
    r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\s*",
    r"[{}]",
)
TEX_FIGURE = r"(?s)\\begin\s*\{figure\*?\}(.*?)\\end\s*\{figure\*?\}"
TEX_LABEL = r"\\label\s*\{([^}]+)\}"
TEX_IMAGE = r"\\(?:includegraphics(?:\[[^\]]*\])?|input)\s*\{([^}]+)\}"
TEX_MENTION = r"\\(?:ref|autoref|cref|Cref)\s*\{([^}]+)\}"

#: A variant's place and gene in a question, and words that look like a gene and aren't one.
CHROMOSOME = r"(?i)chromosome\s+([0-9]+|X|Y)\b"
POSITION = r"(?i)(?:position|location)\s+(\d+)"
GENE_BEFORE_BRACKET = r"\b([A-Z][A-Za-z0-9.-]*(?:, [A-Z][A-Za-z0-9.-]*)*)\s*\("
GENE_AFTER_CUE = r"\b(?:[Gg]ene|impacting|affecting|within|in)\s+([A-Z][A-Za-z0-9.-]*)\b"
NOT_BEFORE_BRACKET = ("DNA", "RNA", "Disease", "Clinical", "Chromosome", "Gene")
NOT_A_GENE = ("Chromosome", "Gene", "Disease", "Clinical")

#: Source labels, and what stands for a disease that isn't given.
LABELS = ("benign", "pathogenic")
NOT_GIVEN = ("", "not provided", "not specified")
#: Texts that stand for no value.
NULL_TEXTS = {"None", "nan", ""}

#: Code fences around a model's JSON, and backslashes that JSON doesn't allow.
JSON_FENCE = r"(?m)^```(?:json)?|```$"
JSON_STRAY_BACKSLASH = r'\\(?!["\\/bfnrtu])'

#: The answer tag of a submission.
ANSWER_TAG = r"\A\s*<answer>([^<>]+)</answer>\s*\z"

#: The standard genetic code, amino acids in the order of codons over TCAG.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Alignment scores: match, mismatch, gap.
ALIGNMENT = (2, -1, -2)

#: The chemical elements.
ELEMENTS = frozenset(
    """H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc
    Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po
    At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og""".split()
)

#: Normal quantile of 0.975.
Z = 1.959963984540054
#: Accuracy must lie strictly within these, and error rates below the third.
GATE = (0.10, 0.70, 0.15)
