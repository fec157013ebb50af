"""Column-expression helpers (built-in Spark functions only, plus two small
Arrow-batched helpers where no built-in expresses the semantics)."""
