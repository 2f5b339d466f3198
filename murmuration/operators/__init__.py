"""Operators: social questions (Q01–Q13) and integer k-means (Q14–Q22)."""
