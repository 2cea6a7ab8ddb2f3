"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tessaria.llm import exact_dedup, langid, license_scan, media, merkle, minhash, mixing, packing, pii, quality, secrets, simhash, whitening

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_simhash": simhash.op2_simhash,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_media": media.op4_media,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_quality": quality.op6_quality,
    "op7_pii": pii.op7_pii,
    "op8_packing": packing.op8_packing,
    "op9_language_id": langid.op9_language_id,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_merkle": merkle.op11_merkle,
    "op12_whitening": whitening.op12_whitening,
    "op13_minhash": minhash.op13_minhash,
}

ORACLES = {
    "op7_pii": pii.SQL,
    "op1_license_scan": license_scan.SQL,
    "op3_mix_sources": mixing.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op11_merkle": merkle.SQL,
    "op13_minhash": minhash.SQL,
}
