"""Readers, writers and stored pools."""
