"""Reading reviews, stopwords and stored counts; writing reports and tables."""
