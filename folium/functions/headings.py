"""Headings of Spanish manuals and legal codes: kinds, ordinals, profiles, and their detection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from folium.functions.text import capitalize, collapse, strip

# Kinds with their labels, ordinals, suffixes and phrases must be these for equal results.
LABELS = {"PARTE": "PARTE", "LIBRO": "LIBRO", "TITULO": "TÍTULO", "CAPITULO": "Capítulo", "SECCION": "Sección", "SUBSECCION": "Subsección", "ARTICULO": "Artículo", "ANEXO": "Anexo"}
SUFFIXES = "Bis|Ter|Qu[áa]ter|Quinquies|Sexies|Septies|Octies|Nonies|Decies|Quintus|Sextus|Septimus|Octavus|Nonus|Decimus"
ORDINALS = "|".join([
    "D[ÉE]CIMO?PRIMER[OA]?", "D[ÉE]CIMO?SEGUND[OA]", "D[ÉE]CIMO?TERCER[OA]?", "D[ÉE]CIMO?CUART[OA]", "D[ÉE]CIMO?QUINT[OA]", "D[ÉE]CIMO?SEXT[OA]", "D[ÉE]CIMO?S[ÉE]PTIM[OA]", "D[ÉE]CIMO?OCTAV[OA]", "D[ÉE]CIMO?NOVEN[OA]",
    "VIG[ÉE]SIMO?PRIMER[OA]?", "VIG[ÉE]SIMO?SEGUND[OA]", "VIG[ÉE]SIMO?TERCER[OA]?", "VIG[ÉE]SIMO?CUART[OA]", "VIG[ÉE]SIMO?QUINT[OA]",
    r"D[ÉE]CIM[OA]\s+PRIMER[OA]?", r"D[ÉE]CIM[OA]\s+SEGUND[OA]", r"D[ÉE]CIM[OA]\s+TERCER[OA]?", r"D[ÉE]CIM[OA]\s+CUART[OA]", r"D[ÉE]CIM[OA]\s+QUINT[OA]", r"D[ÉE]CIM[OA]\s+SEXT[OA]",
    "PRIMER[OA]?", "SEGUND[OA]", "TERCER[OA]?", "CUART[OA]", "QUINT[OA]", "SEXT[OA]", "S[ÉE]PTIM[OA]", "OCTAV[OA]", "NOVEN[OA]", "D[ÉE]CIM[OA]", "VIG[ÉE]SIM[OA]", "UND[ÉE]CIM[OA]", "DUOD[ÉE]CIM[OA]", "[ÚU]NIC[OA]", "PRELIMINAR",
])

_TAIL = r"(?:\s+(.+?))?\s*$"
_SEPARATED = r"(?:\s*[-–:.\s]+(.+))?\s*$"
# For each kind, in the order in which kinds are tried: pattern, group of the ordinal, group of the title (0: none).
PATTERNS = {
    "SUBSECCION": (r"^[\s\-–·]*Subsecci[oó]n\s*\(\s*([A-Z])\s*\)\s*$", 1, 0),
    "ARTICULO": (rf"^\s*Art[íi]culo\s+(\d+)(?:\s*[oº°]\.?)?(?:\s*\.?\s*({SUFFIXES}))?\.?\s*[-–]?\s*(.*)?$", 1, 3),
    "SECCION": (rf"^\s*(?:({ORDINALS})\s+Secci[oó]n|Secci[oó]n\s+({ORDINALS}))\s*$", 1, 0),
    "CAPITULO": (rf"^\s*Cap[ÍI]tulo\s+([IVXLCDM]+(?:\s+(?:Bis|Ter|Quater|Quinquies))?|\d+|[A-Z]){_SEPARATED}", 1, 2),
    "TITULO": (rf"^\s*T[ÍI]TULO\s+([IVXLCDM]+|\d+|{ORDINALS}){_TAIL}", 1, 2),
    "LIBRO": (rf"^\s*Libro\s+({ORDINALS}){_TAIL}", 1, 2),
    "PARTE": (rf"^\s*({ORDINALS})\s+PARTE{_TAIL}", 1, 2),
    "ANEXO": (rf'^\s*Anexo\s*"?([A-Z])"?{_SEPARATED}', 1, 2),
}
_FLAGS = "(?iUd)"
#: How a heading of each kind begins: whether a line does is told without reading it to its end.
STARTS = {
    "SUBSECCION": r"[\s\-–·]*Subsecci", "ARTICULO": r"\s*Art", "SECCION": rf"\s*(?:Secci|Terce|{ORDINALS})", "CAPITULO": r"\s*Cap",
    "TITULO": r"\s*T[ÍI]TULO", "LIBRO": r"\s*Libro", "PARTE": rf"\s*(?:{ORDINALS})\s", "ANEXO": r"\s*Anexo",
}

TYPE = "struct<kind:string, level:int, label:string, ordinal:string, remainder:string, is_anexo:boolean>"


@dataclass(frozen=True)
class Profile:
    """What counts as a heading in a genre, and which lines are dropped, cleaned or noted."""

    name: str
    depths: dict[str, int]
    drops: tuple[str, ...] = ()
    cleans: tuple[tuple[str, str], ...] = ()
    notes: dict[str, str] = field(default_factory=dict)

    @property
    def kinds(self) -> tuple[str, ...]:
        """Active kinds in the order in which they are tried."""
        return tuple(k for k in PATTERNS if k in self.depths)


# The genres' depths, dropped lines and noted reforms.
_REFORM = r"(?iU)(?:Art[íi]culo|Fracci[oó]n|Cap[íi]tulo|P[áa]rrafo|Inciso|T[íi]tulo|Libro)\s+(?:reformad[oa]|adicionad[oa]|derogad[oa])\s+DOF\s+(\d{2}-\d{2}-\d{4})"
_LEGAL_DROPS = (r"(?iU)C[ÁA]MARA\s+DE\s+DIPUTADOS\s+DEL\s+H\.?\s+CONGRESO", r"(?iU)Secretar[íi]a\s+(?:General|de\s+Servicios\s+Parlamentarios)", r"(?U)^\s*\d+\s+de\s+\d+\s*$")
MANUAL = Profile("manual", {"PARTE": 0, "CAPITULO": 1, "SECCION": 2, "SUBSECCION": 3})
LEGAL_CODE = Profile("codigo_legal", {"LIBRO": 0, "TITULO": 1, "CAPITULO": 2}, _LEGAL_DROPS, (), {"reforma_dof": _REFORM})
ORGANIC_LAW = Profile("ley_organica", {"TITULO": 0, "CAPITULO": 1}, (*_LEGAL_DROPS, "(?iU)DOF", "(?iU)Se deroga", r"(?iU)^LEY FEDERAL DE ARMAS DE FUEGO Y EXPLOSIVOS\s*$"), (), {"reforma_dof": _REFORM})
#: Opt-in: articles are nodes below chapters, and reform notices at page heads are dropped.
LEGAL_ARTICLES = replace(LEGAL_CODE, name="codigo_legal_articulos", depths={**LEGAL_CODE.depths, "ARTICULO": 3}, drops=(*_LEGAL_DROPS, r"(?iU)[ÚU]ltima\s+Reforma\s+DOF"))
#: Opt-in: a manual with annexes.
MANUAL_ANNEXES = replace(MANUAL, name="manual_anexos", depths={**MANUAL.depths, "ANEXO": 0})
PROFILES = {p.name: p for p in (MANUAL, LEGAL_CODE, ORGANIC_LAW, LEGAL_ARTICLES, MANUAL_ANNEXES)}


def profile(name: str) -> Profile:
    if name not in PROFILES:
        raise ValueError(f"unknown profile {name!r}; known: {sorted(PROFILES)}")
    return PROFILES[name]


#: The profiles that documents are told to have.
TOLD = ("manual", "codigo_legal", "ley_organica")


def under(chosen: Profile | None, f: Callable[[Profile], Column]) -> Column:
    """f under one profile, or with None under that which each row names in its column `profile`."""
    if chosen is not None:
        return f(chosen)
    out = F.when(F.col("profile") == TOLD[0], f(profile(TOLD[0])))
    for name in TOLD[1:]:
        out = out.when(F.col("profile") == name, f(profile(name)))
    return out


def match(text: Column, kind: str, level: int | None = None) -> Column:
    """The heading of one kind that the text is, or null."""
    pattern, ordinal_at, title_at = PATTERNS[kind]
    pattern = _FLAGS + pattern
    whole = text if kind == "SUBSECCION" else strip(text)
    if kind == "SECCION":
        whole = F.regexp_replace(whole, r"(?iU)Terce\s*r\s*a", "Tercera")
    part = lambda k: F.regexp_extract(whole, pattern, k)
    ordinal = collapse(part(ordinal_at))
    if kind == "SUBSECCION":
        ordinal = F.concat(F.lit("("), F.upper(ordinal), F.lit(")"))
    elif kind == "ARTICULO":
        ordinal = F.concat(ordinal, F.lit("o"), F.when(part(2) != "", F.concat(F.lit(" "), capitalize(part(2)))).otherwise(""))
    elif kind == "SECCION":
        ordinal = capitalize(F.coalesce(F.nullif(ordinal, F.lit("")), collapse(part(2))))
    else:
        ordinal = F.upper(ordinal)
    title = strip(part(title_at)) if title_at else F.lit("")
    fits = whole.rlike(pattern)
    found = F.struct(F.lit(kind).alias("kind"), F.lit(level).cast("int").alias("level"), F.lit(LABELS[kind]).alias("label"), ordinal.alias("ordinal"), title.alias("remainder"), F.lit(kind == "ANEXO").alias("is_anexo"))
    return F.when(fits, found)


def classify(text: Column, chosen: Profile = MANUAL) -> Column:
    """The heading that the text is under the profile, or null; kinds are tried from the most specific on."""
    tried = [match(text, k, chosen.depths[k]) for k in chosen.kinds]
    begins = text.rlike(f"{_FLAGS}^(?:{'|'.join(STARTS[k] for k in chosen.kinds)})")
    return F.when(begins, F.coalesce(*tried) if len(tried) > 1 else tried[0])


def clean(text: Column, chosen: Profile) -> Column:
    for pattern, by in chosen.cleans:
        text = F.regexp_replace(text, pattern, by)
    return text


def dropped(text: Column, chosen: Profile) -> Column:
    """Whether a line of text is dropped: blank, or it holds one of the profile's phrases."""
    out = text.isNull() | ~text.rlike(r"(?U)\S")
    for pattern in chosen.drops:
        out = out | strip(text).rlike(pattern)
    return out


def noted(text: Column, chosen: Profile) -> Column:
    """The notes that a text carries, as a map from name to the first capture; empty if none."""
    found = [F.struct(F.lit(k).alias("key"), F.nullif(strip(F.regexp_extract(text, p, 1)), F.lit("")).alias("value")) for k, p in sorted(chosen.notes.items())]
    empty = F.expr("cast(array() as array<struct<key:string, value:string>>)")
    return F.map_from_entries(F.filter(F.array(*found) if found else empty, lambda x: x["value"].isNotNull()))


def genre(sample: Column) -> Column:
    """The profile that the beginning of a document speaks for."""
    low = F.lower(sample)
    has = lambda p: low.rlike("(?U)" + p)
    book, title, article = has(r"\blibro\s+primero\b"), has(r"\bt[íi]tulo\s+primero\b"), has(r"\bart[íi]culo\s+\d")
    code, part, manual = has("c[óo]digo de"), has(r"\b(?:primera|segunda|tercera)\s+parte\b"), has("manual de")
    return (
        F.when(book & (title | article | code), "codigo_legal")
        .when(title & article & ~book & ~part, "ley_organica")
        .when(part | manual, "manual")
        .when(article, "ley_organica")
        .otherwise("manual")
    )


def depth_label(depth: Column) -> Column:
    """The label of a contents entry that names no kind, by its depth."""
    return F.element_at(F.array(*(F.lit(LABELS[k]) for k in ("PARTE", "CAPITULO", "SECCION", "SUBSECCION"))), F.least(depth, F.lit(3)) + 1)


def without_prefix(title: Column) -> Column:
    """A contents title without its first two words, if they name a heading and more follow; else the title itself."""
    words = F.split(strip(title), r"(?U)\s+", 3)
    names = F.lower(words[0]).rlike(r"(?U)^(cap[íi]tulo|secci[óo]n|subsecci[óo]n|anexo|libro|t[íi]tulo|art[íi]culo)$")
    return F.when(names & (F.size(words) == 3), strip(F.get(words, F.lit(2)))).otherwise(title)
