"""Toxicity: a classifier with a counterfactual penalty on identity terms.

A logistic model of word, word-start and shape features, trained on a bounded
sample of labelled texts. Sentences that mention a group are repeated with
another group of the same kind in its place, and training penalises the change
of the score; so a mention of a group carries no weight of its own, and neutral
mentions are not taken for abuse.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import linear
from tickweave.llm.linear import WORD, word_features

# Identity terms by language and kind; a term is swapped for the others of its kind and language.
IDENTITY_TERMS = {
    "en": {
        "gender": ["women", "men", "girls", "boys", "transgender", "female", "male"],
        "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
        "ethnicity": ["black", "white", "asian", "latino", "african", "european", "arab"],
        "orientation": ["gay", "lesbian", "bisexual", "straight", "homosexual", "heterosexual"],
        "origin": ["immigrant", "immigrants", "refugee", "refugees", "foreigner", "foreigners"],
        "ability": ["deaf", "blind", "disabled", "autistic"],
    },
    "de": {
        "gender": ["frauen", "männer", "mädchen", "jungen", "weiblich", "männlich"],
        "religion": ["christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"],
        "ethnicity": ["schwarze", "weiße", "asiaten", "afrikaner", "europäer", "araber", "türken"],
        "orientation": ["schwule", "lesben", "bisexuelle", "homosexuelle", "heterosexuelle"],
        "origin": ["einwanderer", "flüchtlinge", "ausländer", "migranten"],
        "ability": ["gehörlose", "blinde", "behinderte", "autisten"],
    },
    "es": {
        "gender": ["mujeres", "hombres", "chicas", "chicos", "femenino", "masculino"],
        "religion": ["cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"],
        "ethnicity": ["negros", "blancos", "asiáticos", "latinos", "africanos", "europeos", "árabes", "gitanos"],
        "orientation": ["gays", "lesbianas", "bisexuales", "homosexuales", "heterosexuales"],
        "origin": ["inmigrantes", "refugiados", "extranjeros", "migrantes"],
        "ability": ["sordos", "ciegos", "discapacitados", "autistas"],
    },
    "fr": {
        "gender": ["femmes", "hommes", "filles", "garçons", "féminin", "masculin"],
        "religion": ["chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"],
        "ethnicity": ["noirs", "blancs", "asiatiques", "africains", "européens", "arabes"],
        "orientation": ["gays", "lesbiennes", "bisexuels", "homosexuels", "hétérosexuels"],
        "origin": ["immigrés", "réfugiés", "étrangers", "migrants"],
        "ability": ["sourds", "aveugles", "handicapés", "autistes"],
    },
}

SENTENCE = re.compile(r"[^.!?\n]+")
MOST = {1: 6_000, 0: 12_000}


def swapper(terms: dict[str, dict[str, list[str]]]):
    """A function of a text: feature sets of its sentences that name a group, and of each with the group swapped.

    ``terms``: by language and kind, each one word. A word that two languages
    share is swapped within each.
    """
    others: dict[str, set[str]] = {}
    for kinds in terms.values():
        for group in kinds.values():
            for t in group:
                others.setdefault(t, set()).update(x for x in group if x != t)

    def pairs(text: str | None) -> list[tuple[set[str], set[str]]]:
        out = []
        for s in SENTENCE.findall((text or "").lower()):
            words = set(WORD.findall(s))
            for term in sorted(words & others.keys()):
                mine, rest = word_features(words), words - {term}
                out += [(mine, word_features(rest | {other})) for other in sorted(others[term])]
        return out

    return pairs


def bucket4(id_col: str = "doc_id") -> F.Column:
    """``crc32`` of the id as text, modulo 4 (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)).cast("int")


def train(docs: DataFrame, labels: DataFrame, learn: F.Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", most: dict[int, int] | None = None,
          terms: dict[str, dict[str, list[str]]] | None = None, swap_penalty: float = 1.0) -> linear.Model:
    """Fit on at most ``most[y]`` label rows of each value; ``learn`` restricts label rows (column ``__id``).

    Labels that are null are left out; of several labels of an id the highest
    counts. Without labels of both kinds the model is the share of label 1.
    ``terms``: identity terms by language and kind (default: ``IDENTITY_TERMS``);
    the model's ``swaps`` says how many swapped sentences the penalty had to act on.
    """
    rows = labels.filter(F.col(label_col).isin(0, 1))
    if learn is not None:
        rows = rows.withColumn("__id", F.col(id_col)).filter(learn).drop("__id")
    share = rows.agg(F.count("*").alias("n"), F.sum(F.col(label_col).cast("int")).alias("ones")).first()
    ones = (share["ones"] or 0) / max(1, share["n"])
    got = linear.sample(docs, rows, F.col(label_col), most or MOST, id_col, text_col,
                        swapper(IDENTITY_TERMS if terms is None else terms))
    return linear.fit(got, [0, 1], [1 - ones, ones], swap_penalty=swap_penalty)


def score(docs: DataFrame, model: linear.Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the probability of label 1, from the whole text.

    All rows and columns come back (a column named ``out`` is replaced). A null
    or empty text is scored like any other. No shuffle.
    """
    return docs.withColumn(out, model.column(text_col)[0])
