"""Scoring operators: ``properties`` (O1–O16, S4/S5), ``prototype`` (V1–V6),
``hierarchy`` (H1–H6), ``network`` (N1–N10) and the join helpers in
``joins``."""
