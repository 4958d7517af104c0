"""Thresholds of all operators. The defaults must equal those of published results."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    assign_min_frac: float = 0.10
    assign_min_ratio: float = 1.25
    chimera_primary: float = 0.8
    chimera_secondary: float = 0.2
    chain_q_gap: int = 200_000
    chain_r_gap: int = 400_000
    chain_diag_slop: int = 150_000
    chain_min_bp: int = 0
    chain_min_ident: float = 0.0
    chain_topk: int = 3
    synteny_min_span: int = 50_000
    synteny_min_frac: float = 0.20
    synteny_min_segments: int = 1
    synteny_min_genes: int = 0
    organelle_cov: float = 0.80
    organelle_tol_c: float = 0.05
    organelle_tol_m: float = 0.20
    rdna_min_cov: float = 0.50
    debris_cov: float = 0.80
    debris_ident: float = 0.90
    contaminant_score: int = 1000
    contaminant_cov: float = 0.50
    full_length_ratio: float = 0.80
    full_length_cov: float = 0.70
    telomere_motif: str = "TTTAGGG"
    telomere_window: int = 10_000
    telomere_repeats: int = 3
    cluster_gap: int = 500_000
    rearrangement_frac: float = 0.10
    density_frac: float = 0.15
    translocation_span: int = 50_000
    translocation_bp: int = 10_000
    terminal_bp: int = 100_000
    terminal_frac: float = 0.02
    inversion_span: int = 50_000
    fusion_frac: float = 0.30
    fission_cov: float = 0.50
    fission_single: float = 0.90
    fission_collinear: float = 0.80
    locus_gap: int = 2_000
    array_gap: int = 50_000
    array_min_copies: int = 3
    scaffold_gap: int = 100


DEFAULT = Config()
