"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from dialstat.llm.bpe import op7_bpe
from dialstat.llm.chat_format import OP13_SQL, op13_chat_format
from dialstat.llm.decontaminate import OP8_SQL, op8_decontaminate
from dialstat.llm.jaccard_join import OP1_SQL, op1_jaccard_join
from dialstat.llm.language_id import op9_language_id
from dialstat.llm.language_model import op5_language_model
from dialstat.llm.licenses import op4_licenses
from dialstat.llm.merkle import OP11_SQL, op11_merkle_manifest
from dialstat.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from dialstat.llm.quality import OP6_SQL, op6_quality
from dialstat.llm.sharding import OP2_SQL, op2_sharding
from dialstat.llm.token_files import op10_token_files
from dialstat.llm.warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_jaccard_join": (op1_jaccard_join, OP1_SQL),
    "op2_sharding": (op2_sharding, OP2_SQL),
    "op3_warc": (op3_warc, OP3_SQL),
    "op4_licenses": (op4_licenses, None),
    "op5_language_model": (op5_language_model, None),
    "op6_quality": (op6_quality, OP6_SQL),
    "op7_bpe": (op7_bpe, None),
    "op8_decontaminate": (op8_decontaminate, OP8_SQL),
    "op9_language_id": (op9_language_id, None),
    "op10_token_files": (op10_token_files, None),
    "op11_merkle_manifest": (op11_merkle_manifest, OP11_SQL),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_chat_format": (op13_chat_format, OP13_SQL),
}
