"""Column-expression helpers: tokenising, stop words, the Java-compatible hash
bucket (plus its Arrow-batch form), and engine-independent rounding."""
