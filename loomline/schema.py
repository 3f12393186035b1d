"""Schemas, the fixed label set and the fixed language table."""

from __future__ import annotations

RAW = (
    "id string, text string, seg_langs array<string>, robotstxt string, collection string, u string, "
    "lang array<string>, prob array<double>, doc_scores array<double>"
)
ANNOTATED = (
    "text string, id string, langs array<string>, robotstxt string, collection string, url string, "
    "document_lang string, doc_scores array<double>, line_quality_labels array<string>, quality_scores array<double>"
)
SCORED = "id string, text string, line_quality string"
LLM_RESULT = "doc struct<id: string, text: string, collection: string, url: string>, content array<struct<line: string, label: string>>"
VOCAB = "label string, n bigint"
TRAIN = "text string, label int, split string"
DOC_PRED = "text string, nemotron_label string, hplt_doc_score double"

CLEAN = "Clean"

# The nine line labels with their shorthands.
SHORTHANDS = {
    "clean": "Clean",
    "citations": "Bibliographical & Citation References",
    "contact": "Contact & Identification Information",
    "errors": "Formatting, Style & Errors",
    "legal": "Legal & Administrative Content",
    "interface": "Navigation & Interface Elements",
    "toxic": "Offensive or Inappropriate Content",
    "spam": "Promotional & Spam Content",
    "tech": "Technical Specifications & Metadata",
}
LABELS = list(SHORTHANDS.values())
JUNK_LABELS = LABELS[1:]

# Names of languages by code.
LANGUAGE_OF_CODE = {
    "bul_Cyrl": "Bulgarian",
    "ces_Latn": "Czech",
    "dan_Latn": "Danish",
    "deu_Latn": "German",
    "ell_Grek": "Greek",
    "eng_Latn": "English",
    "est_Latn": "Estonian",
    "ekk_Latn": "Estonian",
    "fin_Latn": "Finnish",
    "fra_Latn": "French",
    "gle_Latn": "Irish",
    "hrv_Latn": "Croatian",
    "hun_Latn": "Hungarian",
    "ita_Latn": "Italian",
    "lav_Latn": "Latvian",
    "ltg_Latn": "Latvian",
    "lvs_Latn": "Latvian",
    "lit_Latn": "Lithuanian",
    "mlt_Latn": "Maltese",
    "nld_Latn": "Dutch",
    "pol_Latn": "Polish",
    "por_Latn": "Portuguese",
    "ron_Latn": "Romanian",
    "slk_Latn": "Slovak",
    "slv_Latn": "Slovene",
    "spa_Latn": "Spanish",
    "swe_Latn": "Swedish",
    "bos_Latn": "Bosnian",
    "cat_Latn": "Catalan",
    "eus_Latn": "Basque",
    "glg_Latn": "Galician",
    "isl_Latn": "Icelandic",
    "kat_Geor": "Georgian",
    "mkd_Cyrl": "Macedonian",
    "sqi_Latn": "Albanian",
    "als_Latn": "Albanian",
    "srp_Cyrl": "Serbian",
    "srp_Latn": "Serbian",
    "tur_Latn": "Turkish",
    "ukr_Cyrl": "Ukrainian",
    "nno_Latn": "Norwegian",
    "nob_Latn": "Norwegian",
    "zho_Hans": "Simplified Chinese",
    "zho_Hant": "Traditional Chinese",
    "ara_Arab": "Arabic",
    "rus_Cyrl": "Russian",
    "tha_Thai": "Thai",
    "hin_Deva": "Hindi",
    "swh_Latn": "Swahili",
    "tel_Telu": "Telugu",
}


def parse_labels(spec: str) -> list[str]:
    """A comma list of labels or shorthands; ``all`` is every label but Clean. Unknown labels raise ValueError."""
    if spec.strip() == "all":
        return list(JUNK_LABELS)
    labels = [SHORTHANDS.get(part.strip(), part.strip()) for part in spec.split(",")]
    if unknown := [x for x in labels if x not in LABELS]:
        raise ValueError(f"not a quality label: {unknown}")
    return labels
