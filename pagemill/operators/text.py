"""Text operators over documents or extracted pages.

These are named by the feature list the project follows but defined here: fields,
thresholds and languages are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as X


def token_rows(docs: DataFrame, id_column: str, text: Column) -> DataFrame:
    """One row per token with its 0-based place."""
    return docs.select(id_column, F.posexplode(X.tokens(text)).alias("pos", "token"))


def kept(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_chars: int = 0,
    min_tokens: int = 0,
    langs: list[str] | None = None,
    min_letter_ratio: float = 0.0,
) -> DataFrame:
    """Documents that pass every test. The language test reaches the scan."""
    passed = docs if langs is None else docs.filter(F.col(lang).isin(*langs))
    return passed.filter(
        (F.length(text) >= min_chars)
        & (X.letter_ratio(F.col(text)) >= min_letter_ratio)
        & (X.token_count(F.col(text)) >= min_tokens)
    )


def expand_entities(tokens: DataFrame, aliases: DataFrame, salts: int = 1) -> DataFrame:
    """Add ``entity``: the canonical name of a token's alias, NULL without one.

    ``aliases`` (``alias, canonical``) may be of any size: Spark broadcasts it when its
    measured size allows and otherwise joins by shuffle. A frequent token then makes
    a hot key; ``salts`` > 1 spreads every token over that many tasks, with the alias
    rows repeated for each, and changes nothing in the result.
    """
    entities = aliases.select(F.col("alias").alias("token"), F.col("canonical").alias("entity"))
    if salts <= 1:
        return tokens.join(entities, "token", "left")
    salted = tokens.withColumn(
        "_salt", F.pmod(F.xxhash64(*[c for c in tokens.columns if c != "token"]), F.lit(salts))
    )
    repeated = entities.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    return salted.join(repeated, ["token", "_salt"], "left").drop("_salt")


def entity_counts(docs: DataFrame, aliases: DataFrame, id_column: str, text: Column, salts: int = 1) -> DataFrame:
    """``entity, n, pos_sum`` by document: each entity with the number of its tokens and the sum of their places.

    Tokens without an entity are one row with a NULL one. Tokens meet the aliases where they are cut, unless the
    aliases are too many to be sent there, and are counted by entity before they are shuffled: a document costs as
    many rows as it has entities, however many words it has.
    """
    found = expand_entities(token_rows(docs, id_column, text), aliases, salts)
    return found.groupBy(id_column, "entity").agg(F.count("*").alias("n"), F.sum("pos").alias("pos_sum"))


def metadata(id_column: str, text: Column, lang: Column) -> Column:
    """What is known of a document, as a JSON object."""
    fields = F.struct(
        F.col(id_column),
        lang.alias("lang"),
        F.length(text).cast("long").alias("n_chars"),
        X.token_count(text).alias("n_tokens"),
        X.line_count(text).alias("n_lines"),
        F.sha2(text, 256).alias("sha256"),
    )
    return F.to_json(fields)


def document_metadata(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One JSON object per document, computed in the scan's own stage."""
    return docs.select(id_column, metadata(id_column, F.col(text), F.col(lang)).alias("metadata"))


def document_entities(docs: DataFrame, aliases: DataFrame, id_column: str, text: Column) -> DataFrame:
    """The sorted entities of each document that has any.

    A document's repeated tokens are merged before they meet the aliases, so a frequent
    word costs one row per document and not one per occurrence.
    """
    words = docs.select(id_column, F.explode(F.array_distinct(X.tokens(text))).alias("token"))
    found = expand_entities(words, aliases).filter(F.col("entity").isNotNull())
    return found.groupBy(id_column).agg(F.array_sort(F.collect_set("entity")).alias("entities"))


def enriched(
    docs: DataFrame,
    aliases: DataFrame | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    cleanup: bool = True,
) -> DataFrame:
    """Extracted text made ready for the next consumer: text, metadata, entities.

    ``cleanup`` and ``aliases`` switch cleaning and entity expansion on.
    """
    body = X.clean(F.col(text)) if cleanup else F.col(text)
    cleaned = docs.select(id_column, F.col(lang).alias("lang"), body.alias("text"))
    result = cleaned.select(
        id_column, "text", metadata(id_column, F.col("text"), F.col("lang")).alias("metadata")
    )
    if aliases is None:
        return result
    entities = document_entities(cleaned, aliases, id_column, X.normalise(F.col("text")))
    return result.join(entities, id_column, "left")
