"""Queries and DuckDB SQL of this subpackage, by registered name."""

from __future__ import annotations

from . import base, bestfit, classlm, decontaminate, importance, langid, linededup, ngramjoin, packing, prefixtrie, quality, secrets, toxicity, urlfilter


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.query,
        "op2_packing": packing.query,
        "op3_url_filters": urlfilter.query,
        "op4_decontamination": decontaminate.query,
        "op5_ngram_jaccard": ngramjoin.query,
        "op6_quality_rules": quality.query,
        "op7_class_lm": classlm.query,
        "op8_secret_scan": secrets.query,
        "op9_line_dedup": linededup.query,
        "op10_language_id": langid.query,
        "op11_prefix_trie": prefixtrie.query,
        "op12_best_fit_packing": bestfit.query,
        "op13_importance_resampling": importance.query,
        "quality_base": base.quality_base,
        "class_lm_base": base.class_lm_base,
        "secret_base": base.secret_base,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filters": urlfilter.ORACLE_SQL,
        "op4_decontamination": decontaminate.ORACLE_SQL,
        "op5_ngram_jaccard": ngramjoin.ORACLE_SQL,
        "op11_prefix_trie": prefixtrie.ORACLE_SQL,
        "op13_importance_resampling": importance.ORACLE_SQL,
        "quality_base": base.QUALITY_SQL,
        "class_lm_base": base.CLASS_LM_SQL,
        "secret_base": base.SECRET_SQL,
    }
