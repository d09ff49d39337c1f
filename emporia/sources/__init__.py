"""emporia.sources"""
