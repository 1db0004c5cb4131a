"""End-to-end compositions of operators: postings fixture, silver, gold."""
