"""Ready-made curation jobs, views and analyses, composed from the operators."""
