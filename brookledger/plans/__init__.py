"""The jobs of each layer, from Bronze to reports."""
