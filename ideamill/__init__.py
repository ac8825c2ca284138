"""ideamill: an idea-management warehouse built as Spark DataFrame jobs."""
