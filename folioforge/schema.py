"""Schemas of papers, blocks and bundles; made without a session, so that modules can be imported before there is one."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()
_STRINGS, _TEXTS = T.ArrayType(_S), T.MapType(_S, _S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


HEADER = _struct(
    paper_id=_S, slug=_S, title=_S, authors=T.ArrayType(_struct(name=_S)), year=_I, doi=_S, arxiv_id=_S, journal=_S, abstract=_S, entry_type=_S, s2_id=_S, external_ids=_TEXTS, keywords=_STRINGS,
    pdf_hash=_S, page_count=_I, source=_S, verified=T.BooleanType(), verify_warnings=_STRINGS, extracted_at=_S, pdf_hash_history=_STRINGS, pdf_hash_enriched=_S,
)
BLOCK = _struct(node_id=_S, page=_I, type=_S, text=_S, section_path=_STRINGS, bbox=T.ArrayType(_I), embeddings=T.MapType(_S, T.ArrayType(T.FloatType())), summaries=_TEXTS, summary=_S, image_base64=_S, image_mime=_S)
ENRICHMENT = _struct(summarizer=_S, paper_summaries=_TEXTS, paper_summary=_S, summary_prompts=T.MapType(_S, _struct(block=_S, paper=_S)), profiles=_STRINGS, embedding_models=T.MapType(_S, _struct(model=_S, dim=_I)))
BUNDLE = _struct(header=HEADER, blocks=T.ArrayType(BLOCK), enrichment_meta=ENRICHMENT)
# The columns of an audit.
AUDIT = ("timestamp", "pdf_path", "success", "updated", "old_title", "new_title", "old_doi", "new_doi", "message", "error")
