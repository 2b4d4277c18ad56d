"""Operators by SURVEY §2 group: validate (V), profile + quantiles (P), clean (F, W), features (E),
transform (M1–M7), select (M8–M10), split (M11–M12), model (M13–M14), metrics (R), joins (J, U)."""
