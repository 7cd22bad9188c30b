"""Queries of this package and their SQL twins."""

from __future__ import annotations

from geoloom.llm import archives, collocations, contamination, conversations, language, licences, minhash, online_packing, packing, private, secrets, toxicity, vectors

QUERIES = {
    "op1_secret_novelty": secrets.op1_secret_novelty,
    "op2_toxicity_chain": toxicity.op2_toxicity_chain,
    "op3_private_terms": private.op3_private_terms,
    "op4_contamination": contamination.op4_contamination,
    "op5_vector_best_fit": packing.op5_vector_best_fit,
    "op6_licences": licences.op6_licences,
    "op7_warc_revisits": archives.op7_warc_revisits,
    "op8_weighted_minhash": minhash.op8_weighted_minhash,
    "op9_language": language.op9_language,
    "op10_quantised_vectors": vectors.op10_quantised_vectors,
    "op11_conversations": conversations.op11_conversations,
    "op12_collocations": collocations.op12_collocations,
    "op13_online_packing": online_packing.op13_online_packing,
}
ORACLES = {"op4_contamination": contamination.OP4_SQL, "op12_collocations": collocations.OP12_SQL}
