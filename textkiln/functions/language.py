"""Language identification with a pluggable model, the language filter, and taggers that route rows by register."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.functions import ranges as R
from textkiln.functions.script import ENGLISH_MARKERS, alnum_words, contamination
from textkiln.functions.text import chars, count_in, let, ratio

#: Least score of a language, and the score of Hindi or Assamese from which a text is contaminated.
LEAST_SCORE, SECONDARY = 0.65, 0.2

#: A factory is called once per worker and gives a function from texts to (label, score, hindi, assamese) for each.
Model = Callable[[list[str]], list[tuple[str, float, float, float]]]


def offline_language(text: Column) -> Column:
    """Struct (lang, score, hindi, assamese) by scripts and English function words, without a model.

    The scores of Bengali, Hindi, Assamese and Latin text are shares of letters; Bengali-script text with Assamese letters is split between
    the two by ten times their share. Latin text is English if a twentieth of its words are English function words, else und.
    """
    count = lambda *groups: chars(text, R.one_of(*groups))
    facts = F.struct(count(R.BENGALI).alias("bn"), count(R.ASSAMESE).alias("asm"), count(R.DEVANAGARI).alias("hi"), chars(text, r"[A-Za-z\x{C0}-\x{24F}]").alias("la"))
    words = let(alnum_words(text), lambda w: ratio(count_in(w, ENGLISH_MARKERS), F.size(w)))
    return let(facts, lambda c: let(F.greatest(F.lit(1), c["bn"] + c["hi"] + c["la"]), lambda n: _language(c, n, words)))


def _language(c: Column, n: Column, english: Column) -> Column:
    leaning = F.least(F.lit(1.0), 10.0 * c["asm"] / F.greatest(F.lit(1), c["bn"]))
    bengali, assamese, hindi, latin = c["bn"] / n * (1 - leaning), c["bn"] / n * leaning, c["hi"] / n, c["la"] / n
    best = F.greatest(bengali, assamese, hindi, latin)
    lang = F.when(best == 0, "und").when(bengali == best, "bn").when(assamese == best, "as").when(hindi == best, "hi").when(english >= 0.05, "en").otherwise("und")
    return F.struct(lang.alias("lang"), best.alias("score"), hindi.alias("hindi"), assamese.alias("assamese"))


def model_language(text: Column, factory: Callable[[], Model], most: int = 5000) -> Column:
    """The same struct by a model, loaded once per worker; like the models it is made for, it sees ``most`` characters on one line."""

    @F.pandas_udf("struct<lang: string, score: double, hindi: double, assamese: double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for texts in batches:
            yield pd.DataFrame(model(texts.fillna("").tolist()), columns=["lang", "score", "hindi", "assamese"])

    return predict(F.substring(F.replace(text, F.lit("\n"), F.lit(" ")), 1, most))


def language_reason(found: Column, text: Column, banglish: Column) -> Column:
    """not_bengali, or the kinds of contamination found in their order; null for kept and for Banglish. ``found``: a language struct."""
    c = contamination(text)
    kinds = [("hindi", found["hindi"] > SECONDARY), ("assamese", found["assamese"] > SECONDARY), ("devanagari", c["devanagari_chars"] > 0), ("assamese_chars", c["assamese_chars"] > 0), ("other_scripts", c["other_script_chars"] > 0)]
    named = F.concat_ws(", ", *[F.when(hit, F.lit(name)) for name, hit in kinds])
    native = (found["lang"] == "bn") & (found["score"] >= LEAST_SCORE)
    return F.when(banglish, None).when(~native, "not_bengali").when(named != "", F.concat(F.lit("contamination: "), named))


def tag_by_register(df: DataFrame, text: str, register: str, native: Callable[[], Model], other: Callable[[], Model] | None = None, most: int = 1000) -> DataFrame:
    """``df`` with label and score: rows of the register 'native' by one model, the rest by another one, or ('unknown', 0.0) without one.

    A model maps texts to (label, score) and is loaded once per worker, when the first row of its kind comes. Null texts are empty.
    """
    names = [c for c in df.columns if c not in ("label", "score")]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names) + ", label string, score double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded: dict[bool, Callable] = {}
        for pdf in batches:
            label, score = pd.Series("unknown", index=pdf.index), pd.Series(0.0, index=pdf.index)
            own = pdf[register] == "native"
            for is_native, factory in ((True, native), (False, other)):
                rows = pdf.index[own == is_native]
                if factory is None or not len(rows):
                    continue
                model = loaded.setdefault(is_native, None) or factory()
                loaded[is_native] = model
                found = model(pdf.loc[rows, text].fillna("").str[:most].tolist())
                label.loc[rows], score.loc[rows] = [x[0] for x in found], [round(x[1], 4) for x in found]
            yield pdf[names].assign(label=label, score=score)

    return df.select(*names).mapInPandas(run, schema)
