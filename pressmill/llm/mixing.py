"""Mixing documents to target weights: iterative proportional fitting of token weights, then calibrated sampling.

The weights of the cells (source, language, topic) are raked until the expected tokens meet the target of each source,
each language and each topic. A document's probability is its cell's ratio of wanted to present tokens, at most one.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import written

MARGINS = ("source", "lang", "topic")
#: targets are the margins' own shares to this power: below 1, small sources, languages and topics gain
TEMPERATURE = 0.7
#: share of all tokens that is wanted
BUDGET = 0.6
ROUNDS = 8
NONE = "(none)"
#: texts that hold no keyword
OTHER = "other"
#: keywords in lower case, in English, French, German and Spanish; a word belongs to one topic
KEYWORDS = {
    "science": """science scientific research theory experiment laboratory physics chemistry biology molecule species planet galaxy
        recherche théorie expérience physique chimie biologie espèce planète wissenschaft forschung theorie physik chemie
        planeten ciencia investigación teoría experimento física química biología especie planeta""",
    "technology": """software computer program code algorithm internet website server network device app robot logiciel ordinateur
        programme algorithme réseau appareil rechner programm algorithmus netzwerk gerät ordenador programa algoritmo red""",
    "health": """health medical medicine doctor patient disease hospital treatment virus cancer santé médecin médecine maladie hôpital
        traitement gesundheit arzt medizin krankheit krankenhaus behandlung salud médico medicina enfermedad tratamiento""",
    "economy": """market company business price bank money trade stock investment tax marché entreprise prix banque argent commerce
        impôt markt unternehmen preis geld handel steuer mercado empresa precio banco dinero comercio impuesto""",
    "politics": """government president minister election parliament law court policy party vote gouvernement président ministre
        élection parlement loi tribunal regierung präsident wahl parlament gesetz gericht gobierno presidente ministro elección ley""",
    "sport": """sport football soccer team player match league coach goal olympic équipe joueur ligue entraîneur fußball mannschaft
        spieler trainer liga fútbol equipo jugador partido entrenador gol""",
    "culture": """music film movie book novel artist museum theatre poem song painting musique livre roman artiste musée théâtre
        chanson musik buch künstler theater lied gemälde música película libro novela artista museo teatro canción""",
}


def topic_of(text: Column) -> Column:
    """A topic for tables without one: that of which the text holds most keywords, the first of equals, OTHER without any.

    Every word of the text counts; words are runs of letters, in any case.
    """
    lists = {t: F.array(*(F.lit(w) for w in words.split())) for t, words in KEYWORDS.items()}
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")
    found = F.array_intersect(words, F.array(*(F.lit(w) for ws in KEYWORDS.values() for w in ws.split())))
    # greatest of (hits, place from the end, topic)
    hits = [F.struct(F.size(F.array_intersect(found, ws)).alias("n"), F.lit(-k).alias("k"), F.lit(t).alias("t"))
            for k, (t, ws) in enumerate(lists.items())]
    none = F.struct(F.lit(0).alias("n"), F.lit(1).alias("k"), F.lit(OTHER).alias("t"))
    return F.greatest(none, *hits)["t"]


def tokens_of(text: Column) -> Column:
    """White-space separated words, at least one, so that an empty text has a weight."""
    return F.greatest(F.lit(1), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")


def chance_of(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    key = F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / 4294967296.0


def topic_in(docs: DataFrame, text_col: str = "text") -> Column:
    """The topic of a row: the table's own column, or that of all words of the text where there is none."""
    return F.coalesce(docs["topic"].cast("string"), F.lit(NONE)) if "topic" in docs.columns else topic_of(docs[text_col])


def keyed(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, source, lang, topic, n_tokens): what mixing looks at; null sources, languages and topics are a group of their own."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col("source"), F.lit(NONE)).alias("source"),
                       F.coalesce(F.col("lang"), F.lit(NONE)).alias("lang"), topic_in(docs, text_col).alias("topic"),
                       tokens_of(F.col(text_col)).alias("n_tokens"))


def rake(cells: DataFrame, budget: float = BUDGET, temperature: float = TEMPERATURE, rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, tokens, ratio) for ``cells`` (source, lang, topic, tokens).

    Each step multiplies the ratios of one margin by target / expected tokens, expected with no ratio over one. The
    cells are far fewer than the documents; each margin is summed on the map side first.
    """
    now = cells.withColumn("ratio", F.lit(1.0))
    total = cells.agg(F.sum("tokens").cast("double").alias("_all"))
    targets = {}
    for m in MARGINS:
        shares = cells.groupBy(m).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temperature)).alias("_raw"))
        # one row of two totals
        scale = shares.agg(F.sum("_raw").alias("_sum")).join(total)
        targets[m] = written(shares.join(F.broadcast(scale)).select(m, (F.col("_raw") / F.col("_sum") * F.col("_all") * budget).alias("_target")))
    for _ in range(rounds):
        for m in MARGINS:
            have = now.groupBy(m).agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("ratio"))).alias("_have"))
            factor = have.join(targets[m], m).select(m, (F.col("_target") / F.col("_have")).alias("_factor"))
            now = now.join(factor, m).select(*MARGINS, "tokens", (F.col("ratio") * F.col("_factor")).alias("ratio"))
        now = written(now)
    return now


def mix(docs: DataFrame, budget: float = BUDGET, temperature: float = TEMPERATURE, rounds: int = ROUNDS, seed: int = 7,
        text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, source, lang, topic, n_tokens, probability, weight, sampled) of every row.

    ``probability`` is the cell's ratio, at most 1; ``weight`` is the tokens the document is expected to give; a document
    is sampled if its own number in [0, 1) is below the probability, so equal ids share their fate. Null texts have one
    token, null ids the number of the word null. An empty table gives no rows.
    """
    slim = written(keyed(docs, text_col, id_col))
    cells = written(slim.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")))
    ratios = rake(cells, budget, temperature, rounds).select(*MARGINS, F.least(F.lit(1.0), F.col("ratio")).alias("probability"))
    return slim.join(ratios, list(MARGINS)).select(
        "id", *MARGINS, "n_tokens", "probability", (F.col("n_tokens") * F.col("probability")).alias("weight"),
        (chance_of(F.col("id"), seed) < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that ``mix`` samples, with their columns; the small table of cells is joined, not the texts."""
    seed = settings.pop("seed", 7)
    cells = written(keyed(docs, text_col, id_col).groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")))
    ratios = rake(cells, **settings).select(*(F.col(m).alias(f"of_{m}") for m in MARGINS), F.col("ratio"))
    # the given row is one column, so that none of its names can clash
    rows = docs.select(F.struct(*docs.columns).alias("row"), *(F.coalesce(F.col(m), F.lit(NONE)).alias(m) for m in ("source", "lang")),
                       topic_in(docs, text_col).alias("topic"), chance_of(F.col(id_col), seed).alias("chance"))
    same = [F.col(m) == F.col(f"of_{m}") for m in MARGINS]
    return rows.join(ratios, same).where(F.col("chance") < F.least(F.lit(1.0), F.col("ratio"))).select("row.*")


def oracle(budget: float = BUDGET, temperature: float = TEMPERATURE, rounds: int = ROUNDS, seed: int = 7) -> str:
    """The same in SQL, one table per raking step."""
    word = r"[^\x20\x09-\x0D]+"
    lists = {t: "[" + ", ".join(f"'{w}'" for w in words.split()) + "]" for t, words in KEYWORDS.items()}
    hits = ", ".join(f"len(list_intersect(words, {ws})) AS n_{t}" for t, ws in lists.items())
    most = "greatest(" + ", ".join(f"n_{t}" for t in lists) + ")"
    topic = f"CASE WHEN {most} = 0 THEN '{OTHER}' " + " ".join(f"WHEN n_{t} = {most} THEN '{t}'" for t in lists) + " END"
    parts = [
        f"d AS MATERIALIZED (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, {topic} AS topic,"
        f" n_tokens FROM (SELECT *, {hits} FROM (SELECT *, list_distinct(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}]+')) AS words,"
        f" greatest(1, len(regexp_extract_all(coalesce(text, ''), '{word}')))::BIGINT AS n_tokens FROM documents)))",
        "w0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens, 1.0::DOUBLE AS ratio FROM d GROUP BY ALL)"]
    for m in MARGINS:
        parts.append(f"t_{m} AS MATERIALIZED (SELECT {m}, r / sum(r) OVER () * (SELECT sum(tokens)::DOUBLE FROM w0) * {budget} AS target FROM"
                     f" (SELECT {m}, pow(sum(tokens)::DOUBLE, {temperature}) AS r FROM w0 GROUP BY {m}))")
    step = 0
    for _ in range(rounds):
        for m in MARGINS:
            parts.append(f"w{step + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, ratio * f AS ratio FROM w{step} JOIN"
                         f" (SELECT h.{m}, target / have AS f FROM (SELECT {m}, sum(tokens * least(1.0, ratio)) AS have FROM w{step}"
                         f" GROUP BY {m}) h JOIN t_{m} USING ({m})) USING ({m}))")
            step += 1
    chance = f"CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT) / 4294967296.0"
    return ("WITH " + ",\n".join(parts) + "\nSELECT doc_id, source, lang, topic, n_tokens, round(least(1.0, ratio), 6) AS probability,"
            f" round(n_tokens * least(1.0, ratio), 3) AS weight, {chance} < least(1.0, ratio) AS sampled"
            f" FROM d JOIN w{step} USING (source, lang, topic)")
