"""Typed tables, star, views, analyses, feeds and checks, each as a lazy DataFrame."""
