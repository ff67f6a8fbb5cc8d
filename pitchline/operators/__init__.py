"""pitchline.operators"""
