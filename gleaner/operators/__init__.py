"""Relational operators over documents, sections, cards, concepts and facts."""
