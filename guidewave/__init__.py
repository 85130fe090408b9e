"""Guidewave: pooled perturbation-screen analytics as Spark DataFrame operators."""
