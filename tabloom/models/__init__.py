"""Feature preparation, classifiers, search and attribution."""
