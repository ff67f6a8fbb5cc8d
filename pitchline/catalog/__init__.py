"""pitchline.catalog"""
