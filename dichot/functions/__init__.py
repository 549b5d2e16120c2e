"""Scalar helpers: distributions (driver), md5 uniforms, Gram partials."""
