import pytest
from pyspark.sql import functions as F

from folium.functions import headings
from folium.operators import elements


def classify(spark, lines, profile):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, t string")
    return [r["h"] for r in rows.withColumn("h", headings.classify(F.col("t"), profile)).orderBy("i").collect()]


def match(spark, line, kind):
    return spark.createDataFrame([(line,)], "t string").select(headings.match(F.col("t"), kind).alias("h")).first()["h"]


def test_manual(spark):
    lines = ["PRIMERA PARTE", "Capítulo III", "Tercera Sección", "Sección Única", "- Subsección (B)", "CAPITULO II BIS", "Terce r a Sección", "  segunda parte de la obra ", "Capítulo IV - La táctica", "capítulo x: órdenes"]
    got = [(h["level"], h["label"], h["ordinal"], h["remainder"]) for h in classify(spark, lines, headings.MANUAL)]
    assert got == [
        (0, "PARTE", "PRIMERA", ""), (1, "Capítulo", "III", ""), (2, "Sección", "Tercera", ""), (2, "Sección", "Única", ""), (3, "Subsección", "(B)", ""), (1, "Capítulo", "II BIS", ""),
        (2, "Sección", "Tercera", ""), (0, "PARTE", "SEGUNDA", "de la obra"), (1, "Capítulo", "IV", "La táctica"), (1, "Capítulo", "X", "órdenes"),
    ]
    assert classify(spark, ["Este es un texto normal.", "", "   ", None, "Artículo 1o.- Uno", "LIBRO PRIMERO", "Sección primera de todas"], headings.MANUAL) == [None] * 7


def test_legal(spark):
    lines = ["LIBRO PRIMERO", "Libro Décimo", "LIBRO DECIMO", "LIBRO PRIMERO De la organización y competencia", "TITULO CUARTO De la prueba", "TITULO PRELIMINAR", "TITULO DECIMOPRIMERO De los delitos", "TITULO DECIMOTERCERO Uno", "TÍTULO XII", "Título 3"]
    got = [(h["label"], h["ordinal"], h["remainder"]) for h in classify(spark, lines, headings.LEGAL_CODE)]
    assert got == [
        ("LIBRO", "PRIMERO", ""), ("LIBRO", "DÉCIMO", ""), ("LIBRO", "DECIMO", ""), ("LIBRO", "PRIMERO", "De la organización y competencia"), ("TÍTULO", "CUARTO", "De la prueba"), ("TÍTULO", "PRELIMINAR", ""),
        ("TÍTULO", "DECIMOPRIMERO", "De los delitos"), ("TÍTULO", "DECIMOTERCERO", "Uno"), ("TÍTULO", "XII", ""), ("TÍTULO", "3", ""),
    ]


@pytest.mark.parametrize(("line", "ordinal", "title"), [("Artículo 1o.- La justicia militar", "1o", "La justicia militar"), ("Artículo 9o. Bis.- x", "9o Bis", "x"), ("Artículo 9o. Ter.-", "9o Ter", ""), ("Articulo 25.- De los", "25o", "De los"), ("Artículo 9o. Quater.-", "9o Quater", ""), ("Artículo 30o. Sexies.-", "30o Sexies", ""), ("Artículo 30o. Septimus.-", "30o Septimus", "")])
def test_articles(spark, line, ordinal, title):
    h = match(spark, line, "ARTICULO")
    assert (h["ordinal"], h["remainder"]) == (ordinal, title)


def test_annexes_and_opt_in_profiles(spark):
    h = match(spark, 'Anexo "A" Formato del Estudio', "ANEXO")
    assert (h["ordinal"], h["is_anexo"], h["remainder"]) == ("A", True, "Formato del Estudio")
    assert match(spark, "Anexos", "ANEXO")["ordinal"] == "S"
    assert classify(spark, ['Anexo "A"'], headings.MANUAL) == [None]
    assert classify(spark, ['Anexo "A"'], headings.MANUAL_ANNEXES)[0]["level"] == 0
    assert classify(spark, ["Artículo 1o.- x"], headings.LEGAL_CODE) == [None]
    assert classify(spark, ["Artículo 1o.- x"], headings.LEGAL_ARTICLES)[0]["level"] == 3
    with pytest.raises(ValueError):
        headings.profile("other")


def test_drops_and_notes(spark):
    lines = ["CÁMARA DE DIPUTADOS DEL H. CONGRESO DE LA UNIÓN", "1 de 141", "Última Reforma DOF 13-06-2014", "  ", None, "Texto", "Secretaría de Servicios Parlamentarios"]
    rows = spark.createDataFrame([(1, i, x, "narrative") for i, x in enumerate(lines)], "doc_id int, pos int, text string, kind string")
    assert [r["pos"] for r in elements.kept(rows, headings.LEGAL_CODE).orderBy("pos").collect()] == [2, 5]
    assert [r["pos"] for r in elements.kept(rows, headings.LEGAL_ARTICLES).collect()] == [5]
    assert elements.drop_counts(rows, headings.ORGANIC_LAW).first()[1:] == (7, 6)
    note = rows.limit(1).select(headings.noted(F.lit("Artículo reformado DOF 13-06-2014"), headings.LEGAL_CODE).alias("n"), headings.noted(F.lit("nada"), headings.LEGAL_CODE).alias("m"), headings.noted(F.lit("x"), headings.MANUAL).alias("o")).first()
    assert note == ({"reforma_dof": "13-06-2014"}, {}, {})


def test_genres(spark):
    docs = {
        1: ["CÓDIGO DE JUSTICIA MILITAR", "LIBRO PRIMERO", "Artículo 1o.- x"], 2: ["MANUAL DE OPERACIONES MILITARES", "PRIMERA PARTE"], 3: ["TÍTULO PRIMERO", "Artículo 1"], 4: ["Artículo 2"], 5: ["nada", None], 6: ["x" * 5000, "LIBRO PRIMERO artículo 1"],
    }
    rows = spark.createDataFrame([(d, i, t) for d, ts in docs.items() for i, t in enumerate(ts)], "doc_id int, pos int, text string")
    got = {r["doc_id"]: r["profile"] for r in elements.genres(rows).collect()}
    assert got == {1: "codigo_legal", 2: "manual", 3: "ley_organica", 4: "ley_organica", 5: "manual", 6: "manual"}


def test_beginnings_hide_no_heading(spark):
    """Whatever a kind's pattern matches begins as its start says, in any case and behind any white space; most lines don't."""
    lines = ["  Capítulo I", "TÍTULO IV", "título preliminar", "lIbRo ÚNICO", " –· subsección ( b )", "terce  r a sección", "SECCIÓN DÉCIMA", "vigésima primera PARTE x", "anexo \"B\" - f", "ANEXOC", "artículo 5o. Bis.- x", "ſección primera", "Primera vez", "La parte primera", "Texto. Capítulo I"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, t string")
    found = 0
    for p in headings.PROFILES.values():
        plain = F.coalesce(*(headings.match(F.col("t"), k, p.depths[k]) for k in p.kinds), F.lit(None))
        for r in rows.select(headings.classify(F.col("t"), p).alias("a"), plain.alias("b")).collect():
            assert r["a"] == r["b"]
            found += r["a"] is not None
    assert found > 15
    start = rows.select(*(F.col("t").rlike(headings._FLAGS + "^(?:" + s + ")").alias(k) for k, s in headings.STARTS.items())).collect()
    assert not any(start[-2]) and not any(start[-1])
