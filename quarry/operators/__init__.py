"""Model and evaluation operators built from DataFrame aggregations: k-means,
logistic regression, Naive Bayes, hashed TF-IDF, evaluation metrics, reports."""
