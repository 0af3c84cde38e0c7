"""Phrase translation and language codes as a folded CASE expression.

The dictionary is fixed and tiny (4 phrases x 10 languages), so instead of a
join it is compiled into one native expression: no shuffle, no broadcast,
whole-stage codegen. Matching is on the lower-cased text, in dictionary
order; the replacement is case-sensitive (so 'Hello' is returned unchanged),
and text without a known phrase gets the placeholder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col_

# Supported languages (in order) and their codes.
LANGUAGE_CODES = {
    "spanish": "es", "french": "fr", "german": "de", "italian": "it", "portuguese": "pt",
    "japanese": "ja", "chinese": "zh", "korean": "ko", "russian": "ru", "arabic": "ar",
}

# The phrase dictionary, phrase -> language code -> translation, in order.
TRANSLATIONS = {
    "hello": {"es": "hola", "fr": "bonjour", "de": "hallo", "it": "ciao", "pt": "olá",
              "ja": "こんにちは", "zh": "你好", "ko": "안녕하세요", "ru": "привет", "ar": "مرحبا"},
    "goodbye": {"es": "adiós", "fr": "au revoir", "de": "auf wiedersehen", "it": "arrivederci",
                "pt": "adeus", "ja": "さようなら", "zh": "再见", "ko": "안녕히 가세요",
                "ru": "до свидания", "ar": "وداعا"},
    "thank you": {"es": "gracias", "fr": "merci", "de": "danke", "it": "grazie", "pt": "obrigado",
                  "ja": "ありがとう", "zh": "谢谢", "ko": "감사합니다", "ru": "спасибо", "ar": "شكرا"},
    "how are you": {"es": "¿cómo estás?", "fr": "comment vas-tu?", "de": "wie geht es dir?",
                    "it": "come stai?", "pt": "como vai você?", "ja": "お元気ですか？", "zh": "你好吗？",
                    "ko": "어떻게 지내세요?", "ru": "как дела?", "ar": "كيف حالك؟"},
}

# Fixed choice for the driver data: ISO code of a document -> language name.
CODE_TO_NAME = {"en": "english", "es": "spanish", "fr": "french", "de": "german"}


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def language_name(code) -> Column:
    """ISO code of a driver document -> language name (NULL when unmapped)."""
    return F.try_element_at(_map(CODE_TO_NAME), col_(code))


def language_code(name) -> Column:
    """Language name (case-insensitive) -> code, NULL when unsupported."""
    return F.try_element_at(_map(LANGUAGE_CODES), F.lower(col_(name)))


def unsupported_message(lang: Column) -> Column:
    return F.concat(F.lit("Error: Unsupported language '"), lang,
                    F.lit(f"'. Supported languages are: {', '.join(LANGUAGE_CODES)}"))


def translate(text, target_language) -> Column:
    t = col_(text)
    lang = F.lower(col_(target_language))
    code = language_code(lang)
    low = F.lower(t)
    out = F.when(code.isNull(), unsupported_message(lang))
    for phrase, per_lang in TRANSLATIONS.items():
        out = out.when(low.contains(phrase), F.replace(t, F.lit(phrase), F.try_element_at(_map(per_lang), code)))
    return out.otherwise(F.concat(F.lit("[Translation of '"), t, F.lit("' to "), lang, F.lit("]")))


def language_table(spark: SparkSession) -> DataFrame:
    """(ord, language, code): fixed, 10 rows."""
    return spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(LANGUAGE_CODES.items())],
                                 "ord int, language string, code string")


def phrase_table(spark: SparkSession) -> DataFrame:
    """(ord, phrase, code, translation): fixed, 40 rows."""
    rows = [(i, p, c, t) for i, (p, d) in enumerate(TRANSLATIONS.items()) for c, t in d.items()]
    return spark.createDataFrame(rows, "ord int, phrase string, code string, translation string")
