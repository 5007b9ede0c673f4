"""The queries of this package: name -> function(spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from .chat_format import OP10_SQL, op10_chat_formatting
from .decontaminate import op2_decontamination
from .embedding_dedup import OP6_SQL, op6_embedding_dedup
from .html_extraction import op1_html_extraction
from .language_id import op13_language_id
from .packing import op8_best_fit_packing
from .quality import op5_quality_resampling
from .sharding import OP7_SQL, op7_sharding
from .simhash_dedup import op3_simhash_dedup
from .source_divergence import OP11_SQL, op11_source_divergence
from .token_files import op4_token_files
from .warc_archive import OP9_SQL, op9_warc_archive
from .whitening import op12_embedding_whitening

QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_decontamination, op3_simhash_dedup, op4_token_files, op5_quality_resampling, op6_embedding_dedup, op7_sharding,
    op8_best_fit_packing, op9_warc_archive, op10_chat_formatting, op11_source_divergence,
    op12_embedding_whitening, op13_language_id)}

SQL: dict[str, str] = {
    "op6_embedding_dedup": OP6_SQL, "op7_sharding": OP7_SQL, "op9_warc_archive": OP9_SQL,
    "op10_chat_formatting": OP10_SQL, "op11_source_divergence": OP11_SQL}
